"""Mixing, embeddings, secrets, the quality classifier, components, the pipeline."""

import random
import re
from functools import reduce

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

import brute
import samples
from grantchron.llm import automata, embedding_dedup, mixing, quality, secret_scan
from grantchron.llm.components import components
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(0, 60)), max_size=8), st.integers(0, 120))
def test_seats_by_highest_quotients(parties, seats):
    shares, most = [float(s) for s, _ in parties], [m for _, m in parties]
    assert mixing.sainte_lague(shares, seats, most) == brute.highest_quotients(shares, seats, most)


def test_targets_stop_and_share_anew():
    found = mixing.targets({"a": 10, "b": 100, "c": 1000, None: 0})
    assert found == {"a": 30.0, "b": 300.0, "c": 780.0, None: 0.0}
    assert mixing.targets({}) == {}


def test_mix_takes_what_sources_are_to_give(spark):
    docs = samples.documents(spark)
    found = mixing.mix(docs, shard_rows=10).collect()
    rows = samples.rows()
    assert len(found) == len(rows)
    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    sources = {}
    for r in rows:
        sources[r[3]] = sources.get(r[3], 0) + size(r[1])
    wanted = mixing.targets(sources)
    taken = dict.fromkeys(sources, 0)
    for r in found:
        assert r["size"] == size(r.text) and r.source_size == sources[r.source]
        assert r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.taken <= 3 * r["size"] and 0 <= r.copies <= 3 * (r["size"] > 0)
        taken[r.source] += r.taken
    for s, t in taken.items():
        assert abs(t - wanted[s]) <= 8 * mixing.BLOCK
    again = mixing.mix(docs.repartition(3), shard_rows=10).collect()
    assert brute.multiset(found) == brute.multiset(again)
    assert mixing.mix(samples.no_documents(spark)).collect() == []


def vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 24))
    found = [v for v in base] + [v + rng.normal(size=24) * 0.15 for v in base for _ in range(4)]
    found += [base[0], base[0], base[1] * 3, base[2] * 1e-20, base[3] * 1e30]
    rows = [(i * 7 % 1009, [float(np.float32(x)) for x in v], "l") for i, v in enumerate(found)]
    odd = [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] * 24, [1.0, 2.0], [2.0, 4.0]]
    rows += [(2000 + i, v, None) for i, v in enumerate(odd)]
    return [*rows, (None, rows[0][1], "n"), rows[5]]


@pytest.mark.parametrize("block_dims", (5, 11, 24))
def test_embeddings_against_all_cosines(spark, block_dims):
    rows = vectors()
    schema = "vec_id long, embedding array<float>, id string"
    frame = spark.createDataFrame(rows, schema).repartition(4)
    linked = {i: set() for i in range(len(rows))}

    def fit(r):
        v = r[1]
        return r[0] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if fit(a) and fit(b) and len(a[1]) == len(b[1]):
                x, y = np.float64(np.float32(a[1])), np.float64(np.float32(b[1]))
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.95:
                    linked[i].add(j)
                    linked[j].add(i)
    found = embedding_dedup.embedding_dedup(frame, block_dims=block_dims).collect()
    least = brute.groups(range(len(rows)), linked)
    first = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            first[least[i]] = min(first.get(least[i], r[0]), r[0])
    expected = [(r[0], len(linked[i]), first.get(least[i]) if r[0] is not None else None) for i, r in enumerate(rows)]
    assert brute.multiset(tuple(r)[:3] for r in found) == brute.multiset(expected)
    assert sum(e[1] for e in expected) > 200
    none = spark.createDataFrame([], schema)
    assert embedding_dedup.embedding_dedup(none).collect() == []


def _all_cosines(found):
    unit = found / np.linalg.norm(found, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    near = {i: set(np.flatnonzero(x).tolist()) for i, x in enumerate(linked)}
    least = brute.groups(range(len(found)), near)
    return {i: (len(near[i]), least[i]) for i in range(len(found))}


@pytest.mark.parametrize("cell_rows", (32, 100, 1000))
def test_embeddings_in_many_boxes_and_chunks(spark, cell_rows):
    rng = np.random.default_rng(8)
    some = rng.normal(size=(900, 24))
    group = rng.normal(size=24) + rng.normal(size=(300, 24)) * 0.02  # no split parts these
    found = np.concatenate((some, some[::3] + rng.normal(size=(300, 24)) * 0.15, group))
    found = found.astype(np.float32).astype(np.float64)
    rows = [(i, v.tolist()) for i, v in enumerate(found)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = embedding_dedup.embedding_dedup(frame, cell_rows=cell_rows).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == _all_cosines(found)


def test_boxes_follow_the_rows_and_chunks_bound_tasks():
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(20_000, 11)) / 8
    shares = []
    for depth in (2, 6):
        boxes = embedding_dedup._split(vectors, 0.131, depth)
        home, row, _ = embedding_dedup._places(vectors, boxes, 0.131**2)
        counts = np.bincount(home)
        assert len(counts) == 2**depth and counts.max() < 1.5 * len(vectors) / 2**depth
        shares.append((len(row) + len(home)) / len(home) / 2**depth)
    assert shares[1] < shares[0] / 3
    keys = rng.integers(-(2**62), 2**62, 5_000)
    met, sizes = {}, {}
    for home, chunks in ((True, (5, 3)), (False, (5, 3))):
        for left, right, own, rows in embedding_dedup.tasks(keys, home, chunks):
            sizes[left, right] = sizes.get((left, right), 0) + len(rows)
            met.setdefault((left, right), []).append((home, own))
    assert len(met) == 5 * 6 // 2 + 5 * 3 and max(sizes.values()) < 3_000


def test_a_task_returns_counts_not_pairs(spark):
    rng = np.random.default_rng(10)
    group = (rng.normal(size=24) + rng.normal(size=(400, 24)) * 0.02).astype(np.float32)
    facts = np.stack((np.arange(400), np.arange(400), np.ones(400)), 1).astype(np.int64)
    n_links, least = np.zeros(400, np.int64), []
    for block in range(len(embedding_dedup.blocks(24))):
        table = pa.table(
            {"dims": [24], "block": [block], "cell": [0], "left": [0], "right": [0], "own": [True],
             "facts": [facts.tobytes()], "vectors": [group.tobytes()]}
        )
        got = embedding_dedup._links(0.95, embedding_dedup.BLOCK_DIMS, "<f4")(table)
        assert len(got) <= 400
        np.add.at(n_links, got["key"].to_numpy(), got["n"].to_numpy())
        least += got["least"].to_pylist()
    assert (n_links == 399).all() and min(least) == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60) if i % 20] + [(100, i) for i in range(101, 140)]
    links += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7), (None, 3)]
    linked = {}
    for a, b in links:
        if a is not None and a != b:
            linked.setdefault(a, set()).add(b)
            linked.setdefault(b, set()).add(a)
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == brute.groups(linked, linked)


def test_fixed_secrets_are_the_patterns_matches(spark):
    docs = samples.documents(spark)
    found = secret_scan.secret_scan(docs).collect()
    assert len(found) == len(samples.rows())
    assign = re.compile(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A
    )
    texts = {r[0]: r[1] or "" for r in samples.rows()}
    for r in found:
        text, spans = texts[r.doc_id], []
        spans += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert [(s.start, secret_scan.KINDS.index(s.kind), s.end) for s in r.fixed] == sorted(spans)
    assert sum(len(r.fixed) for r in found) >= 5
    assert secret_scan.secret_scan(samples.no_documents(spark)).collect() == []


def test_formats_catch_credentials_without_a_name(spark):
    rng = random.Random(3)
    key = lambda: "AKIA" + "".join(rng.choices("ABCDEFGHJKLMNPQRSTUVWXYZ234567", k=16))
    value = lambda: "sk-" + "".join(rng.choices("ghijklmnopqrstuvwxyz0123456789", k=28))
    word = lambda: "".join(rng.choices(["tion", "ing", "the", "er", "an"], k=6))
    rows = [(i, f"{word()} token={value()} {word()} {key()}") for i in range(300)]
    rows += [(1000 + i, f"{word()} {value()} {word()}") for i in range(15)]
    found = secret_scan.secret_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = dict(rows)
    added = [(texts[r.doc_id][s.start : s.end], r.doc_id) for r in found for s in r.added]
    assert all(t.startswith("sk-") and i >= 1000 for t, i in added)
    assert len(added) >= 12


def test_an_automaton_merges_what_it_cannot_tell_apart():
    rng = random.Random(0)
    strings = ["AK" + "".join(rng.choices("xy", k=rng.randint(1, 9))) for _ in range(500)]
    states = automata.learn(strings)
    assert len(states) < 12
    assert automata.log_likelihood(states, "AKxyxy") > automata.log_likelihood(states, "xyxyAK")
    assert automata.learn([])[0].count == 0


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").dropDuplicates(["doc_id"])
    split = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(3)) == 0
    model = quality.fit(docs, labels.filter(~split))
    held = quality.score(docs, model).join(labels.filter(split), "doc_id")
    rows = held.select("keep", "quality").collect()
    good = [r.keep for r in rows if r.quality == 1]
    bad = [r.keep for r in rows if r.quality == 0]
    assert len(bad) > 100 and sum(good) / len(good) > 0.995 and sum(bad) / len(bad) < 0.05


def test_classifier_without_labels_or_documents(spark):
    docs = samples.documents(spark)
    schema = "doc_id long, quality int, text string"
    one_sided = spark.createDataFrame([(0, 1, "x"), (37, 1, "x"), (74, None, "x"), (9, 5, "x")], schema)
    for labels in (spark.createDataFrame([], schema), one_sided):
        scored = quality.score(docs, quality.fit(docs, labels)).collect()
        assert len(scored) == len(samples.rows()) and all(r.keep and r.score == 1.0 for r in scored)
    none = samples.no_documents(spark)
    assert quality.score(none, quality.fit(none, one_sided)).collect() == []
    halves = spark.createDataFrame([(i * 37 % 997, i % 2, "x") for i in range(50)], schema)
    scored = quality.score(docs, quality.fit(docs, halves)).collect()
    assert len(scored) == len(samples.rows()) and all(0 <= r.score <= 1 for r in scored)


def test_pipeline_keeps_the_columns_and_only_drops_what_it_decides(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "ngram_join", "mix", "bpe"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).checkpoint()
        assert after.schema.names == docs.columns, name
        assert after.exceptAll(before).join(before, docs.columns, "left_anti").count() == 0
        if name in ("exact_dedup", "ngram_join"):
            rows = {r.doc_id: r.text for r in before.collect()}
            stay = {r.doc_id for r in after.collect()}
            numbered = sorted(rows.items())
            if name == "exact_dedup":
                first = {}
                for i, text in numbered:
                    first.setdefault(" ".join(re.split(r"[\x20\x09-\x0D]+", text)), i)
                assert stay == set(first.values())
            else:
                linked = brute.jaccard_links(numbered, 5, 0.8)
                least = brute.groups(range(len(numbered)), linked)
                assert stay == {i for k, (i, _) in enumerate(numbered) if least[k] == k}
        before = after
    encoded = corpus_pipeline.run(spark, SF)
    assert encoded.count() == before.count()
    assert {r.doc_id for r in encoded.select("doc_id").collect()} == {r.doc_id for r in before.collect()}


def test_pipeline_stages_keep_columns_that_clash(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    own = {c: F.concat(F.lit(f"{c} "), F.col("doc_id")) for c in (
        "copy", "copies", "size", "source_size", "target", "taken", "score", "keep", "p_text", "p_known",
        "kept_id", "own_0", "row", "id", "label", "c0", "tie", "shard",
    )}
    docs = docs.withColumns(own)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        wrong = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(value) for c, value in own.items()])
        assert after.count() > 0 and after.filter(wrong).count() == 0, name


def test_every_document_may_be_taught(spark):
    """Of documents of a source without labels some get labels, and the bounds are parameters."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    few = quality.fit(docs, labels, labelled=400, rounds=1, each_round=10)
    more = quality.fit(docs, labels, labelled=400, rounds=2, each_round=200)
    again = quality.fit(docs.repartition(7), labels, labelled=400, rounds=2, each_round=200)
    assert not np.allclose(few.text, more.text) and np.allclose(more.text, again.text)
