"""Substring and suffix-array deduplication, exact deduplication, and the n-gram join."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import brute
import samples
from grantchron.llm import exact_dedup, ngram_join, postings, substring_dedup, suffix_dedup
from grantchron.llm.suffix_array import suffix_array
from pyspark.sql import functions as F


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_suffix_array_is_the_order_of_suffixes(text):
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_array_of_runs_and_periods():
    for text in (b"a" * 300, b"ab" * 150, b"aab" * 90 + b"a", b"mississippi" * 20):
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_substrings_against_brute_force(spark):
    rows = samples.rows()
    documents = [(k, re.findall(r"[^\x20\x09-\x0D]+", k[1])) for k in brute.by_id(rows)]
    # Documents that share an id come in the order of a hash; here none share one with other text.
    gone = brute.repeated(documents, substring_dedup.WINDOW)
    expected = {
        k[0]: (len(w), sum(gone[k]), " ".join(x for x, g in zip(w, gone[k]) if not g))
        for k, w in documents
    }
    found = substring_dedup.substring_dedup(samples.documents(spark), buckets=5).collect()
    assert len(found) == len(rows)
    assert sum(r.n_removed for r in found) > 1000
    for r in found:
        key = brute.LAST if r.doc_id is None else r.doc_id
        assert (r.n_words, r.n_removed, r.kept) == expected[key]
        assert sum(s.end - s.start for s in r.removed) == r.n_removed


@pytest.mark.parametrize("shift", range(14))
def test_a_window_is_found_at_any_alignment(spark, shift):
    rng = random.Random(shift)
    window = [f"w{rng.random()}" for _ in range(20)]
    a = [f"a{i}" for i in range(rng.randrange(14))] + window + ["end"]
    b = [f"b{i}" for i in range(shift)] + window
    docs = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b))], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in substring_dedup.substring_dedup(docs, buckets=2).collect()}
    assert kept == {1: " ".join(a), 2: " ".join(b[:shift])}


def test_bytes_against_brute_force(spark):
    rows = samples.rows()
    documents = [(k, k[1].encode()) for k in brute.by_id(rows)]
    gone = brute.repeated(documents, suffix_dedup.WINDOW)
    found = suffix_dedup.suffix_dedup(samples.documents(spark), buckets=5).collect()
    assert len(found) == len(rows)
    expected = {
        k[0]: (len(b), sum(gone[k]), bytes(x for x, g in zip(b, gone[k]) if not g))
        for k, b in documents
    }
    assert sum(e[1] for e in expected.values()) > 10_000
    for r in found:
        key = brute.LAST if r.doc_id is None else r.doc_id
        assert (r.n_bytes, r.n_removed, bytes(r.kept)) == expected[key]


def test_variants_that_overlap_in_part_meet_in_a_suffix_array():
    rng = random.Random(4)
    core = bytes(rng.randrange(97, 123) for _ in range(150))
    pieces = [core[i : i + 120] for i in (0, 9, 20, 30, 9, 15)]
    pieces += [b"x" * 20 + core[10:120], core[25:140] + b"y" * 10]
    expected, seen = set(), set()
    for i, p in enumerate(pieces):
        for s in range(len(p) - 99):
            if p[s : s + 100] in seen:
                expected.add((i, s))
            seen.add(p[s : s + 100])
    found = suffix_dedup.repeats_among(pieces, np.zeros(len(pieces), np.uint64))
    assert {(i, s + k) for i, s, n in found for k in range(n)} == expected


@pytest.mark.parametrize("step", (60, 101, 250, 1000))
def test_stretches_of_a_document_are_the_same_beside_others(monkeypatch, step):
    rng = random.Random(6)
    texts = [bytes(rng.choices(b"abcd ", k=k)) for k in (130, 700, 0, 99, 1900, 100)] + [b"x" * 400]
    expected = [
        [x.tolist() for x in suffix_dedup.stretches(np.frombuffer(t, np.uint8), np.array([0, len(t)]))]
        for t in texts
    ]
    monkeypatch.setattr(suffix_dedup, "_STEP", step)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    for data, at, wanted in [
        (b"".join(texts), offsets, [(o, e) for o, e in zip(offsets, expected)]),
        *((t, np.array([0, len(t)]), [(0, e)]) for t, e in zip(texts, expected)),
    ]:
        first, count, hashes = suffix_dedup.stretches(np.frombuffer(data, np.uint8), at)
        assert first.tolist() == [o + s for o, e in wanted for s in e[0]]
        assert count.tolist() == [n for _, e in wanted for n in e[1]]
        assert hashes.tolist() == [h for _, e in wanted for h in e[2]]


def test_exact_copies_against_sql_rules(spark):
    rows = samples.rows()
    clean = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
    found = exact_dedup.exact_dedup(samples.documents(spark), salts=3).collect()
    expected = []
    for r, text in zip(rows, clean):
        members = [q[0] for q, t in zip(rows, clean) if t == text]
        keep = min((m for m in members if m is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        expected.append((r[0], keep, len(members), r[0] == keep, digest))
    assert brute.multiset(map(tuple, found)) == brute.multiset(expected)


def test_texts_with_one_digest_stay_apart(spark):
    docs = spark.createDataFrame(
        [(i, f"text {i % 3}") for i in range(30)], "doc_id long, text string"
    )
    weak = exact_dedup.exact_dedup(docs, digest=lambda text: F.length(text).cast("string"))
    assert {(r.keep_id, r.group_size) for r in weak.collect()} == {(0, 10), (1, 10), (2, 10)}


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands, rows = ngram_join.bands_and_rows(threshold, 0.99)
        assert 1 - (1 - threshold**rows) ** bands >= 0.99


@pytest.mark.parametrize("chunk", (3, 512))
def test_ngram_links_against_brute_force(spark, chunk):
    rows = samples.rows()
    linked = brute.jaccard_links(rows, 5, 0.8)
    least = brute.groups(range(len(rows)), linked)
    members = {}
    for i in range(len(rows)):
        members.setdefault(least[i], []).append(i)
    found = ngram_join.ngram_join(samples.documents(spark), chunk=chunk).collect()
    expected = [
        (r[0], len(linked[i]), min((rows[j][0] for j in members[least[i]] if rows[j][0] is not None), default=None))
        for i, r in enumerate(rows)
    ]
    assert brute.multiset((r.doc_id, r.n_links, r.component_id) for r in found) == brute.multiset(expected)
    assert max(e[1] for e in expected) >= 7
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_nothing_gives_nothing(spark):
    none = samples.no_documents(spark)
    for operator in (
        substring_dedup.substring_dedup,
        suffix_dedup.suffix_dedup,
        exact_dedup.exact_dedup,
        ngram_join.ngram_join,
    ):
        assert operator(none).collect() == []


def thue_morse(n):
    """Two words of n letters whose polynomials agree for every odd base modulo 2**64."""
    a = "a"
    while len(a) < n:
        a += a.translate({97: 98, 98: 97})
    return a[:n], a[:n].translate({97: 98, 98: 97})


@pytest.mark.parametrize("letters", (8, 64, 65, 1024, 2048, 70_000))
def test_words_that_weak_hashes_take_for_equal(spark, letters):
    one, other = thue_morse(letters)
    rest = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{one} {rest}"), (2, f"{other} {rest}"), (3, f"{one} b c d e"), (4, f"{other} b c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    removed = {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(docs, buckets=4).collect()}
    assert set(removed.values()) == {0}
    links = {r.doc_id: r.n_links for r in ngram_join.ngram_join(docs).collect()}
    # Of 16 five-grams of 1 and 2, the first alone differs.
    assert links == {1: 1, 2: 1, 3: 0, 4: 0}


def test_a_text_longer_than_a_step(spark):
    rng = random.Random(4)
    words = [f"{rng.randrange(10**6)}" for _ in range(200_000)]
    words[150_000:150_030] = words[10:40]
    rows = [(1, " ".join(words)), (2, " ".join(words[100_000:100_025])), (3, "x" * 70_000 + " y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(docs, buckets=4).collect()}
    assert found == {1: (200_000, 30), 2: (25, 25), 3: (2, 0)}


def test_documents_without_an_id_are_spread_over_buckets(spark):
    rows = [(None, f"text {i}") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = postings.texts_by_bucket(postings.keyed(docs, "doc_id", "text"), 64)
    most = texts.groupBy("bucket").count().agg(F.max("count"), F.count("bucket")).first()
    assert most[0] < 50 and most[1] > 55


def test_buckets_follow_the_bytes_of_text(spark):
    docs = spark.createDataFrame([(1, "x" * 1000)] * 300, "doc_id long, text string")
    joined = docs.join(docs.select("doc_id").distinct(), "doc_id")
    assert postings.buckets_for(joined, least=1, megabytes=1) == 1
    assert postings.buckets_for(docs.crossJoin(spark.range(10)), least=1, megabytes=1) == 2
