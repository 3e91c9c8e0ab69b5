"""Phrase mining against plain counts, with tries that burst and spill and prefixes that are cut."""

import random
import re
import tracemalloc
from collections import Counter

import pytest

import samples
from grantchron.llm import collocations, word_trie

SCHEMA = "doc_id long, text string, lang string, source string, f long, phrase string, part int, run string"


def plain_counts(rows, least):
    found = Counter()
    for text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    found[lang or "und", n, " ".join(words[i : i + n])] += 1
            if words:
                found[lang or "und", 0, ""] += len(words)
    return {k: n for k, n in found.items() if n >= least or k[1] == 0}


def plain_collocations(rows, least, top):
    counts = plain_counts(rows, 1)
    by_lang = {}
    for (lang, n, phrase), a in counts.items():
        if n < 2 or a < least:
            continue
        words = phrase.split(" ")
        cuts = []
        for k in range(1, n):
            left = counts[lang, k, " ".join(words[:k])]
            right = counts[lang, n - k, " ".join(words[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        if n == 2 and any(
            m == 3 and lang == other and 100 * f >= 50 * a and f >= least and f" {phrase} " in f" {longer} "
            for (other, m, longer), f in counts.items()
        ):
            continue
        by_lang.setdefault(lang, []).append((-score, -a, phrase.encode(), left, right))
    return {
        (lang, rank, phrase.decode(), -a, left, right, counts[lang, 0, ""], -score)
        for lang, found in by_lang.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    }


def texts():
    rng = random.Random(2)
    words = ["the", "of", "Tea", "pot", "élan", "ÉLAN", "日本", "a" * 300, "b", "x-y", "(q)", "\x0b", "\x85z"]
    found = []
    for i in range(150):
        n = rng.randint(0, 40)
        picked = [rng.choice(words[: 3 + i % 11]) + rng.choice(["", "", "", ",", ". ", "\n", "!?"]) for _ in range(n)]
        found.append((rng.choice([" ", " ", "\t", "  "]).join(picked), rng.choice(["en", "en", None, "de", "d"])))
    found += [("of the " + rng.choice("pqrstuv") + str(rng.randint(0, 90)) + " end.", "en") for _ in range(300)]
    found += [("so it goes", "en")] * 12 + [("So It; goes so it goes", "en")] * 3
    found += [(t, "xx") for t in samples.texts()] + [(None, "en"), ("", None), ("w " * 9_000, "loop")]
    return found


@pytest.mark.parametrize(("burst", "most", "part_bytes"), [(1 << 14, 10**6, 1 << 23), (5, 60, 500)])
def test_counts_against_plain_ones(spark, burst, most, part_bytes):
    rows = texts()
    frame = spark.createDataFrame([(None, t, x, None, 1, "p", 2, "r") for t, x in rows], SCHEMA).repartition(4)
    options = {"burst": burst, "most": most, "part_bytes": part_bytes}
    found = collocations.phrase_counts(frame, least=3, **options).collect()
    assert {(r.lang, r.words, r.phrase): r.f for r in found} == plain_counts(rows, 3)
    assert len(found) == len(plain_counts(rows, 3))
    best = collocations.collocations(frame, least=3, top=25, **options).collect()
    assert {tuple(r) for r in best} == plain_collocations(rows, 3, 25)
    assert len(best) == len({tuple(r) for r in best})


def test_hot_parts_are_dealt_by_salt(spark, monkeypatch):
    monkeypatch.setattr(collocations, "HOT_ROWS", 5)
    rows = texts()
    frame = spark.createDataFrame([(1, t, x, None, 1, "p", 2, "r") for t, x in rows], SCHEMA)
    best = collocations.collocations(frame, least=2, top=40).collect()
    assert {tuple(r) for r in best} == plain_collocations(rows, 2, 40)


def test_no_texts(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(none).collect() == []
    blank = spark.createDataFrame([(1, None, None, None, 1, "p", 2, "r"), (1, " .\n", "en", None, 1, "p", 2, "r")], SCHEMA)
    assert collocations.phrase_counts(blank).collect() == []


def test_scores_beyond_64_bits(spark):
    a = 40_000_000_000_000
    rows = [("en", 1, "x", a + 2), ("en", 1, "y", a + 1), ("en", 2, "x y", a)]
    frame = spark.createDataFrame(rows, "lang string, words int, phrase string, f long")
    [row] = collocations.scored(frame).collect()
    assert row.score == 1_000_000 * a * a // ((a + 1) * (a + 2))


def test_tries_spill_runs_by_partition():
    trie = word_trie.Trie(burst=2, most=10, own=2)
    rng = random.Random(1)
    words = [bytes([97 + i]) for i in range(20)]
    import numpy as np

    expected, got = Counter(), Counter()
    splitters = sorted({(b"g", *(words[rng.randrange(20)] for _ in range(3))) for _ in range(4)} | {(b"a", b"", b"", b"")})
    for _ in range(60):
        paths = np.array([[rng.randint(1, 20) for _ in range(30)] for _ in range(3)])
        for path in paths.T.tolist():
            expected[tuple(words[i - 1] for i in path)] += 1
        trie.add("g", np.sort(word_trie.pack(paths)))
        if trie.full():
            for group, runs in trie.spill(words, rng.random()):
                for part, some in word_trie.by_partition(group, runs, splitters):
                    again = word_trie.merged([word_trie.dump(some), word_trie.dump(some)])
                    for path, n in zip(again.paths.T.tolist(), again.counts.tolist()):
                        key = tuple(again.words[i - 1] for i in path)
                        assert part == sum(s <= (b"g", *key) for s in splitters)
                        assert n % 2 == 0
                        got[key] += n // 2
    for _, runs in trie.spill(words):
        for path, n in zip(runs.paths.T.tolist(), runs.counts.tolist()):
            got[tuple(runs.words[i - 1] for i in path)] += n
    assert got == expected and trie.size == 0


def runs_of(n_runs, n_paths, n_words):
    """Dumped runs of one group, and the counts of their paths by words."""
    import numpy as np

    rng = np.random.default_rng(3)
    words = sorted(b"word%06d" % i for i in range(n_words))
    blobs, counts = [], Counter()
    for _ in range(n_runs):
        paths = np.stack([rng.integers(1, min(40, n_words + 1), n_paths), *rng.integers(0, n_words + 1, (2, n_paths))])
        paths[2, paths[1] == 0] = 0
        run = word_trie.in_order(words, paths, rng.integers(1, 4, n_paths))
        blobs.append(word_trie.dump(run))
        for path, n in zip(run.paths.T.tolist(), run.counts.tolist()):
            counts[tuple(run.words[i - 1] if i else b"" for i in path)] += n
    return blobs, counts


@pytest.mark.parametrize("bits", [63, 0])
def test_merged_runs_have_sums_in_order(monkeypatch, bits):
    monkeypatch.setattr(word_trie, "PACKED_BITS", bits)
    blobs, counts = runs_of(5, 400, 12)
    found = word_trie.merged(blobs)
    paths = [tuple(found.words[i - 1] if i else b"" for i in path) for path in found.paths.T.tolist()]
    assert paths == sorted(counts) and found.words == sorted(found.words)
    assert dict(zip(paths, found.counts.tolist())) == counts


@pytest.mark.parametrize("least", [1, 10])
def test_merge_of_a_partition_holds_few_bytes_a_path(monkeypatch, least):
    n_runs, n_paths = 600, 500
    list(collocations._prefix_sums(0, "en", word_trie.merged(runs_of(1, 9, 9)[0]), [], 1))  # imports what it needs
    blobs, counts = runs_of(n_runs, n_paths, 3_000)
    tracemalloc.start()
    try:
        runs = word_trie.merged(blobs)
        n = 0
        for found in collocations._prefix_sums(0, "en", runs, [], least):
            n += len(found[1]) if len(found) == 3 and isinstance(found[2], type(runs.counts)) else 1
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    ones, pairs = Counter(), Counter()
    for path, f in counts.items():
        ones[path[0]] += f
        if path[1]:
            pairs[path[:2]] += f
    whole = {p: f for p, f in counts.items() if p[2]}
    assert n == 1 + sum(f >= least for c in (ones, pairs, whole) for f in c.values())
    assert peak / (n_runs * n_paths) < 120


def test_words_are_numbered_anew_within_a_task(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(word_trie, "WORDS", 30)
    monkeypatch.setattr(collocations, "CHUNK", 20)
    rng = random.Random(5)
    rows = [(" ".join(f"w{rng.randint(0, 15 + i)}" for _ in range(50)), "en") for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*((x, t) for t, x in rows))], names=["lang", "text"])
    blobs = [b for out in collocations._count([], 1 << 14, 10**6)(iter([batch])) for b in out["run"].to_pylist()]
    assert len(blobs) > 5
    found = collocations._prefix_sums(0, "en", word_trie.merged(blobs), [], 2)
    counts = {("en", n, p.decode()): f for n, phrases, fs in found for p, f in zip(phrases.to_pylist(), fs.tolist())}
    assert counts == plain_counts(rows, 2)
