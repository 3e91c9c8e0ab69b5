"""Personal data (13): fixed patterns, and a skip-chain conditional random field.

What the patterns find are labels. The field (`skip_chain`) learns from a sample of documents how
labelled tokens look and follow each other, and that tokens of a document which repeat or
resemble each other have one label. Over all documents, messages then carry the labels that are
certain to tokens that no pattern matches: a number written once with its country code, and
without it elsewhere. Tokens without a digit or an @ are none of these kinds.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from grantchron.llm import hashing, skip_chain
from grantchron.llm.skip_chain import FEATURES, Field, Graph

KINDS = ("email", "ip", "card", "phone")  # in the order that spans with one start take
LEARN_DOCS = 1_500  # documents with spans to learn from, and as many without, by least hash
LEARN_TOKENS = 2_000  # most tokens of a document to learn from
SURE = 0.9  # probability from which a token gets a label
_SALTS = 64

_DIGIT = re.compile("[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# From the first digit of a run only: from a later one there is no match either.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(
    r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
)
_NOT_DIGIT = re.compile("[^0-9]+")
_SPACES = "\x20\t\n\x0b\x0c\r"


class Span(NamedTuple):
    start: int
    kind: int  # place in KINDS
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) << (i & 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _octets(parts: tuple[str, ...]) -> bool:
    return all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in parts)


def _emails(text: str) -> Iterator[Span]:
    """An address begins as far back from its @ as it may: at most at the end of the last one."""
    done, at = 0, text.find("@")
    while at >= 0:
        local = text[done:at]
        size = len(local) - len(local.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if size else None
        if domain:
            yield Span(at - size, 0, domain.end())
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """Leftmost matches, apart within a kind, by start and then kind; code points, end exclusive."""
    found = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        found += [Span(m.start(), 1, m.end()) for m in _IP.finditer(text) if _octets(m.groups())]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _NOT_DIGIT.sub("", m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append(Span(m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    found.append(Span(m.start(), 3, m.end()))
    return sorted(found)


class Token(NamedTuple):
    """A word with a digit or an @, without the signs around it; `beside` the token before."""

    start: int
    end: int
    text: str
    beside: bool
    before: str  # the word before, if it is no token


def tokens(text: str) -> list[Token]:
    found, last = [], -1
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        while not (text[start].isalnum() or text[start] in "+(@"):
            start += 1
        while not (text[end - 1].isalnum() or text[end - 1] in ")@"):
            end -= 1
        gap = text[last : m.start()] if 0 <= last and m.start() - last < 4 else "-"
        beside = not gap.strip(_SPACES)
        near = "" if beside else text[max(m.start() - 24, 0) : m.start()].lower().split()[-1:]
        found.append(Token(start, end, text[start:end], beside, near[0] if near else ""))
        last = m.end()
    return found


SLOTS = 9


def _shape(word: str) -> str:
    out = []
    for c in word[:64]:
        s = "9" if "0" <= c <= "9" else "a" if c.islower() else "A" if c.isupper() else c
        if not out or out[-1] != s:
            out.append(s)
    return "".join(out)


def _features(token: Token) -> list[int]:
    word = token.text
    digits = _NOT_DIGIT.sub("", word)
    parts = word.split(".")
    octets = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts) and _octets(tuple(parts))
    number = 12 <= len(digits) <= 19 and luhn(digits)
    names = [
        "bias",
        f"shape {_shape(word)}",
        f"digits {min(len(digits), 24)}",
        f"length {min(len(word) // 4, 12)}",
        f"octets {octets}",
        f"number {number} {len(digits) == len(word)}",
        f"at {word.count('@')} {word.count('.')}",
        f"plus {word[:1] == '+'} {'-' in word} {'(' in word}",
        f"before {token.before[-12:]}",
    ]
    return [zlib.crc32(n.encode()) % FEATURES for n in names]


def _alike(word: str) -> Iterator[str]:
    """What a token shares with those that repeat or resemble it."""
    low = word.lower()
    if len(low) >= 6:
        yield low
        name = low.split("@", 1)[0]
        if name != low and len(name) >= 6:
            yield name
    digits = _NOT_DIGIT.sub("", word)
    if len(digits) >= 7 and not any(c.isalpha() for c in word):
        yield digits[-7:]


def graph_of(found: list[Token], base: list[Span]) -> Graph:
    """One document's tokens; those that a span of `base` touches have its kind + 1, others 0."""
    given, spans = np.zeros(len(found), np.int64), sorted(base)
    first = 0
    for i, token in enumerate(found):
        while first < len(spans) and spans[first].end <= token.start:
            first += 1
        touching = [s.kind for s in spans[first : first + 4] if s.start < token.end and s.end > token.start]
        if touching:
            given[i] = min(touching) + 1
    named: dict[str, list[int]] = {}
    for i, token in enumerate(found):
        for name in dict.fromkeys(_alike(token.text)):
            named.setdefault(name, []).append(i)
    groups = [members for members in named.values() if len(members) > 1]
    member = [(i, g) for g, members in enumerate(groups) for i in members]
    links = [(i - 1, i) for i, token in enumerate(found) if i and token.beside]
    return Graph(
        np.array([_features(t) for t in found], np.int64).reshape(-1, SLOTS),
        given,
        np.array(links, np.int64).reshape(-1, 2),
        np.array(member, np.int64).reshape(-1, 2),
        len(groups),
    )


def _as_json(graph: Graph) -> str:
    return json.dumps([x.tolist() if isinstance(x, np.ndarray) else x for x in graph])


def _from_json(text: str) -> Graph:
    features, given, links, member, groups = json.loads(text)
    return Graph(
        np.array(features, np.int64).reshape(-1, SLOTS),
        np.array(given, np.int64),
        np.array(links, np.int64).reshape(-1, 2),
        np.array(member, np.int64).reshape(-1, 2),
        groups,
    )


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (hash, text, drawn): graphs of documents with spans, and of those drawn without."""
    for batch in batches:
        rows = []
        for digest, text, drawn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            base = base_spans(text)
            found = tokens(text) if base or drawn else []
            if 0 < len(found) <= LEARN_TOKENS:
                rows.append((digest, bool(base), _as_json(graph_of(found, base))))
        digests, spans, graphs = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.int64()), pa.array(spans, pa.bool_()), pa.array(graphs, pa.string())],
            names=["digest", "spans", "graph"],
        )


def learn(docs: DataFrame, text_col: str = "text", learn_docs: int = LEARN_DOCS) -> Field | None:
    """The field of a sample of documents: `learn_docs` with base spans, and as many without.

    All documents with base spans, and some others, are candidates for the sample; different
    texts with the least hashes are taken, with at most LEARN_TOKENS tokens each. The weights are
    fitted in one task. None if no document has a token.
    """
    n = docs.count()
    share = min(1.0, 40 * learn_docs / max(n, 1))
    digest = F.xxhash64(F.lit("personal"), text_col)
    drawn = F.pmod(F.xxhash64(text_col), F.lit(1 << 20)) < int(share * (1 << 20))
    graphs = (
        docs.filter(F.col(text_col) != "")
        .select(digest.alias("digest"), text_col, drawn.alias("drawn"))
        .mapInArrow(_examples, "digest long, spans boolean, graph string")
        .groupBy("digest", "spans")
        .agg(F.min("graph").alias("graph"))  # copies have one graph
    )
    salted = Window.partitionBy("spans", F.pmod("digest", F.lit(_SALTS))).orderBy("digest")
    whole = Window.partitionBy("spans").orderBy("digest")
    some = graphs.withColumn("place", F.row_number().over(salted))
    some = some.filter(F.col("place") <= max(4 * learn_docs // _SALTS, 1))
    sample = some.withColumn("place", F.row_number().over(whole)).filter(F.col("place") <= learn_docs)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["spans", "digest"])
        graph = skip_chain.joined([_from_json(g) for g in rows.graph], SLOTS)
        return pd.DataFrame({"field": [skip_chain.fit(graph, len(KINDS) + 1).dump()]})

    found = sample.select("digest", "spans", "graph").groupBy().applyInPandas(fit, "field binary").collect()
    return Field.load(bytes(found[0]["field"])) if found else None


def _added(found: list[Token], given: np.ndarray, labels: np.ndarray) -> list[Span]:
    """Spans of tokens that have a label but no base span; side by side they are one span."""
    spans: list[Span] = []
    open_kind = -1  # of the span that the last token belongs to
    for token, mine, label in zip(found, given.tolist(), labels.tolist(), strict=True):
        if mine or not label:
            open_kind = -1
            continue
        if token.beside and open_kind == label - 1 and open_kind >= 2:  # numbers may have spaces
            spans[-1] = Span(spans[-1].start, open_kind, token.end)
        else:
            spans.append(Span(token.start, label - 1, token.end))
        open_kind = label - 1
    return spans


_SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_TOKENS_AT_ONCE = 200_000


def _listed(spans: list[Span]) -> list[dict]:
    return [{"kind": KINDS[s.kind], "start": s.start, "end": s.end} for s in spans]


def scan(
    docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text", sure: float = SURE
) -> DataFrame:
    """Rows (id_col, base, added): the spans of each whole text, by start and then kind.

    Null or empty texts have none; rows with null or repeated ids are each scanned; other columns
    of docs are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, added = [], []
            waiting: list[tuple[int, list[Token], Graph]] = []

            def label() -> None:
                if not waiting:
                    return
                whole = skip_chain.joined([g for _, _, g in waiting], SLOTS)
                p = skip_chain.infer(whole, field)
                best = np.where(p.max(1) >= sure, p.argmax(1), 0)
                at = 0
                for place, found, graph in waiting:
                    added[place] = _listed(_added(found, graph.given, best[at : at + len(found)]))
                    at += len(found)
                waiting.clear()

            size = 0
            for text in batch.column(1).to_pylist():
                spans = base_spans(text or "")
                base.append(_listed(spans))
                added.append([])
                found = tokens(text) if text and field is not None else []
                if found:
                    waiting.append((len(base) - 1, found, graph_of(found, spans)))
                    size += len(found)
                if size >= _TOKENS_AT_ONCE:
                    label()
                    size = 0
            label()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, _SPAN_TYPE), pa.array(added, _SPAN_TYPE)],
                names=[id_col, "base", "added"],
            )
        hashing.give_back_memory()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, base {_SPANS}, added {_SPANS}")


def private_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """learn and scan over the same documents."""
    return scan(docs, learn(docs, text_col), id_col, text_col)
