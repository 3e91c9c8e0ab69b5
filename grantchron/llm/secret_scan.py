"""Secret scans (6): patterns, and automata of the formats that labelled credentials have.

What the patterns of FIXED kinds find in the corpus are labelled credentials. From a sample of
each kind's different values, and of other long words, probabilistic automata are learned by
merging compatible prefix-tree states (`automata`). Every other run of credential characters in
every text is a candidate, scored by how much likelier its format is under a kind's automaton
than under that of other words. Those nearer to the kind's held-out values than to where held-out
words end are spans of kind `format`.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from grantchron.llm import automata

#: The fixed kinds in the order that spans with one start take.
FIXED = ("assign", "access", "hex")
KINDS = (*FIXED, "format")
LEARNED, HELD_OUT = 400, 200  # different strings of each kind to learn from and to calibrate by
LONGEST = 256  # characters of a string to learn from
SHORTEST = 16  # characters of a candidate

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
_NAMES = ("passw", "secret", "token", "api")


class Span(NamedTuple):
    start: int
    kind: int  # place in KINDS
    end: int
    value: str

    def __str__(self) -> str:
        return f"{KINDS[self.kind]}:{self.start}:{self.end}"


def fixed_spans(text: str) -> list[Span]:
    """Leftmost matches, apart within a kind, by start and then kind; code points, end exclusive."""
    found = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                found.append(Span(m.start(), 0, m.end(), m[2]))
    if "AKIA" in text:
        found += [Span(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    found += [Span(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, fixed: list[Span]) -> Iterator[re.Match]:
    """Runs of SHORTEST or more credential characters that touch no fixed span."""
    spans = iter(sorted((s.start, s.end) for s in fixed))
    span, reach = next(spans, None), 0
    for m in _CANDIDATE.finditer(text):
        while span and span[0] < m.end():
            reach = max(reach, span[1])
            span = next(spans, None)
        if reach <= m.start():
            yield m


class Formats(NamedTuple):
    """For each fixed kind its automaton and the score from which a word has its format."""

    kinds: tuple[tuple[list[automata.State], float], ...]
    words: list[automata.State]

    def holds(self, word: str) -> bool:
        if not self.kinds:
            return False
        base = automata.log_likelihood(self.words, word)
        return any(automata.log_likelihood(s, word) - base > least for s, least in self.kinds)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kinds, values = [], []
        for text in batch.column(0).to_pylist():
            if text:
                fixed = fixed_spans(text)
                kinds += [KINDS[s.kind] for s in fixed]
                values += [s.value for s in fixed]
                others = [m[0] for m in candidates(text, fixed)]
                kinds += ["word"] * len(others)
                values += others
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(values, pa.string())], names=["kind", "value"]
        )


def _learn(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("place")
    learned, held = rows[rows.place <= LEARNED], rows[rows.place > LEARNED]
    if not len(held):  # too few to set some aside
        held = learned
    states = [vars(s) for s in automata.learn(learned.value)]
    return pd.DataFrame(
        {
            "kind": [rows.kind.iloc[0]],
            "states": [json.dumps(states)],
            "held": [json.dumps(list(held.value))],
        }
    )


def learn_formats(docs: DataFrame, text_col: str = "text") -> Formats:
    """Formats of the labelled credentials in docs.

    All rows are searched. Of each kind's different values, LEARNED + HELD_OUT by least hash,
    of at most LONGEST characters, are learned from and calibrated by. Without other words, or
    of a kind that was not found, there is no format.
    """
    order = Window.partitionBy("kind").orderBy(F.xxhash64("value"), "value")
    sample = (
        docs.select(text_col)
        .mapInArrow(_examples, "kind string, value string")
        .filter(F.length("value") <= LONGEST)
        .distinct()
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= LEARNED + HELD_OUT)
    )
    learned = {
        r.kind: ([automata.State(**s) for s in json.loads(r.states)], json.loads(r.held))
        for r in sample.groupBy("kind")
        .applyInPandas(_learn, "kind string, states string, held string")
        .collect()  # four rows at most
    }
    if "word" not in learned:
        return Formats((), [])
    words, held_words = learned["word"]

    def scores(states: list[automata.State], strings: list[str]) -> list[float]:
        return sorted(
            automata.log_likelihood(states, s) - automata.log_likelihood(words, s) for s in strings
        )

    kinds = []
    for kind in FIXED:
        if kind in learned:
            states, held = learned[kind]
            typical = scores(states, held)
            other = scores(states, held_words)  # some may be credentials that have no label
            low, high = other[len(other) // 4], other[len(other) * 3 // 4]
            above = high + 2 * (high - low)
            least = max(above, (above + typical[len(typical) // 20]) / 2)
            kinds.append((states, least))
    return Formats(tuple(kinds), words)


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def scan(
    docs: DataFrame, formats: Formats, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (id_col, fixed, added): the spans of each whole text, by start and then kind.

    Null or empty texts have none; rows with null or repeated ids are each scanned; other columns
    of docs are left out.
    """
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fixed, added = [], []
            for text in batch.column(1).to_pylist():
                found = fixed_spans(text or "")
                fixed.append([{"kind": KINDS[s.kind], "start": s.start, "end": s.end} for s in found])
                added.append(
                    [
                        {"kind": "format", "start": m.start(), "end": m.end()}
                        for m in candidates(text or "", found)
                        if formats.holds(m[0])
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fixed, spans), pa.array(added, spans)],
                names=[id_col, "fixed", "added"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, fixed {_SPANS}, added {_SPANS}"
    )


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """learn_formats and scan over the same documents."""
    return scan(docs, learn_formats(docs, text_col), id_col, text_col)
