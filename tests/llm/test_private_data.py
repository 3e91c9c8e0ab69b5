"""Personal data: base spans against plain patterns, the field against all labellings."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import samples
from grantchron.llm import private_data as private, skip_chain
from grantchron.llm.queries import QUERIES

PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def plain_spans(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub(r"\D", "", m[0], flags=re.ASCII)
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
            if (
                kind == 0
                or (kind == 1 and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == 2 and 12 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0)
                or (kind == 3 and 9 <= len(digits) <= 15)
            ):
                found.append((m.start(), kind, m.end()))
    return sorted(found)


CARDS = ("4111 1111 1111 1111", "4111-1111-1111-1112", "378282246310005", "5555555555554444")
SAID = (
    "a@b.c", "x.y+z@host.example.com", "@", "a@b", "..@.", "a@b.c.@d.e", "é@x.de", "a@b..c", "1.2.3.4", "1.2.3.4.5",
    "256.1.1.1", "0001.02.3.255", "9.9.9.9.9.9.9.9", "+1 (017) 555-7713", "+49.30-123456", "+1", "+12 3", "++44 20 7946",
    "0" * 40, "12", "3 4", "- 5", "日本", " ", "\n", ".", "-", *CARDS,
)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(SAID), st.text("aZ09.@+-() _%é", max_size=6)), max_size=12))
def test_base_spans_against_patterns(parts):
    text = "".join(parts)
    assert private.base_spans(text) == plain_spans(text)


def test_long_texts_take_linear_time():
    for unit in ("x", "1", "a@", "1.", "+1 ", "+", "@@", "9" * 50 + ".", ". ", "1-"):
        text = unit * (300_000 // len(unit))
        private.base_spans(text)
        found = private.tokens(text)
        private.graph_of(found[:3000], [])


def test_messages_find_the_labels_of_a_tree():
    rng = np.random.default_rng(3)
    field = skip_chain.Field(rng.normal(size=(skip_chain.FEATURES, 3)), rng.normal(size=(3, 3)), 1.3)
    graph = skip_chain.Graph(
        rng.integers(0, skip_chain.FEATURES, (5, 2)),
        np.array([0, 2, 0, 0, 0]),
        np.array([(0, 1), (1, 2), (3, 4)]),
        np.array([(2, 0), (3, 0)]),
        1,
    )
    scores = {}
    for ys in itertools.product(range(3), repeat=6):
        score = sum(field.emit[f, y] for fs, y in zip(graph.features, ys) for f in fs)
        score += 30 * (ys[1] == 2) + sum(field.follow[ys[a], ys[b]] for a, b in graph.links)
        scores[ys] = score + 1.3 * ((ys[2] == ys[5]) + (ys[3] == ys[5]))
    total = np.logaddexp.reduce(list(scores.values()))
    expected = [[np.exp(np.logaddexp.reduce([s for ys, s in scores.items() if ys[i] == y]) - total) for y in range(3)] for i in range(5)]
    assert np.allclose(skip_chain.infer(graph, field), expected, atol=2e-3)
    alone = skip_chain.infer(skip_chain.joined([graph, graph], 2), field)
    assert np.array_equal(alone[:5], alone[5:]) and np.array_equal(alone[:5], skip_chain.infer(graph, field))


def learned():
    rng = random.Random(5)

    def number(n):
        return "".join(rng.choices("0123456789", k=n))

    graphs = []
    for _ in range(400):
        phone = f"+1 ({number(3)}) 555-{number(4)}"
        mail = f"name{number(2)}.x@mail{number(1)}.example.com"
        ip = ".".join(str(rng.randint(1, 255)) for _ in range(4))
        words = [phone, mail, ip, number(5), f"v{number(1)}.{number(1)}", f"{number(4)}-{number(2)}-{number(2)}"]
        text = " and so ".join(rng.sample(words, 4) + [rng.choice(words)])
        graphs.append(private.graph_of(private.tokens(text), private.base_spans(text)))
    return skip_chain.fit(skip_chain.joined(graphs, private.SLOTS), 5)


def test_labels_go_to_tokens_that_resemble_each_other():
    field = learned()

    def added(text):
        found, base = private.tokens(text), private.base_spans(text)
        graph = private.graph_of(found, base)
        p = skip_chain.infer(graph, field)
        best = np.where(p.max(1) >= private.SURE, p.argmax(1), 0)
        return [(private.KINDS[s.kind], text[s.start : s.end]) for s in private._added(found, graph.given, best)]

    far = " words between them" * 300
    assert added("call +1 (151) 555-1234 now" + far + " or just 555-1234.") == [("phone", "555-1234")]
    assert added("call 151-555-1234 on 2024-11-02 about v1.2, and again 2024-11-02") == []
    # The pattern takes both numbers for one that is too long.
    assert ("phone", "+1 (151) 555-1234") in added("is +1 (151) 555-1234 12345")
    assert skip_chain.fit(skip_chain.joined([], private.SLOTS), 5).agree == 0


def test_spans_of_documents(spark):
    rows = samples.rows()
    rows += [(7000 + i, " ".join(random.Random(i).choices(SAID, k=30)), "en", None, 1, *samples.EXTRA) for i in range(40)]
    docs = spark.createDataFrame(rows, samples.SCHEMA).repartition(5)
    found = private.private_data(docs).collect()
    expected = sorted((repr(r[0]), plain_spans(r[1] or "")) for r in rows)
    assert sorted((repr(r.doc_id), [(s.start, private.KINDS.index(s.kind), s.end) for s in r.base]) for r in found) == expected
    again = private.private_data(docs.repartition(2)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    for r in found:
        assert not any(a.start < b.end and b.start < a.end for a in r.added for b in r.base)
    assert private.private_data(samples.no_documents(spark)).collect() == []


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_query_against_patterns(spark, sf):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op13_private_data"](spark, sf).collect()
    assert len(rows) == len(texts)
    more = 0
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        listed = [f"{private.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        spans = r.spans.split(",") if r.spans else []
        assert set(listed) <= set(spans)
        more += len(spans) - len(listed)
    assert more <= 0.05 * sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) + 2
