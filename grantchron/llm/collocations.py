"""Phrase collocation mining (12): phrases of words that occur together far more than apart.

Each task counts the sequences of up to three words that begin at each of its words in a
HAT-trie (`word_trie`), whose subtrees it spills as sorted runs. Runs meet by prefix: the order
of all sequences is cut into partitions, by a sample, so that a word or a pair that a third of
all places begin with is spread as far as its continuations go. A partition merges its runs and
has the counts of all sequences that begin in it, and those of their prefixes by sums. Candidates
then find the counts of their parts by joins.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from grantchron.llm import hashing, word_trie
from grantchron.llm.word_trie import Splitter
from grantchron.session import materialize

LEAST, TOP = 10, 2_000
PART_BYTES = 8 << 20  # of text for a prefix partition
SAMPLES, MOST_SAMPLES = 30, 1_000_000  # paths for a partition, and in all, to place its borders by
_SAMPLED_FROM_ONE = 32  # paths of one document
_SPLITTER_BYTES = 64  # of a word in a splitter
CHUNK = 400_000  # words numbered at a time
BLOCK = 100_000  # phrases written at once
HOT_ROWS = 100_000
_SALTS = 64
NO_LANG = "und"

_RUNS = "part int, lang string, run binary"
_COUNTS = "lang string, words int, phrase binary, f long"


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Bytes with A-Z lowered, and the kind of each: 0 of a word, 1 a space, 2 the end of a piece."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    kind = np.zeros(256, np.uint8)
    kind[[0x20, 0x09]] = 1
    kind[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
    return lower, kind


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts: their bytes in a row, where each ends there, its row, and its piece."""
    lower, kinds = _tables()
    kind = kinds[data]
    solid = kind == 0
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = solid[inner]
    starts = np.flatnonzero(begins)
    before = np.cumsum(solid)
    ends = np.empty(len(starts), np.int64)
    if len(starts):
        ends[:-1] = before[starts[1:]] - 1
        ends[-1] = before[-1]
    row = np.searchsorted(offsets, starts, "right") - 1
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
    return lower[data[solid]], ends, row, piece


def _paths(ids: np.ndarray, row: np.ndarray, piece: np.ndarray, n: int) -> np.ndarray:
    """For each of the first n words the path that begins there; ids are from 1 on."""
    whole = np.zeros((3, n), np.int64)
    whole[0] = ids[:n]
    joined = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
    second = np.zeros(n, bool)
    second[: len(joined)] = joined[:n]
    third = np.zeros(n, bool)
    third[: max(len(joined) - 1, 0)] = (joined[:-1] & joined[1:])[:n]
    whole[1, second] = ids[1:][: n][second[: len(ids) - 1]] if len(ids) > 1 else 0
    whole[2, third] = ids[2:][: n][third[: len(ids) - 2]] if len(ids) > 2 else 0
    return whole


class _Words:
    """Words numbered from 1 on, as they come."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}

    def ids(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        array = pa.BinaryArray.from_buffers(
            pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        number, found = self.number, array.dictionary.to_pylist()
        known = list(map(number.get, found))
        for i, n in enumerate(known):
            if n is None:
                known[i] = number[found[i]] = len(number) + 1
        return np.array(known, np.int64)[np.asarray(array.indices)] if known else np.empty(0, np.int64)


def _chunks(
    batches: Iterator[pa.RecordBatch], words: _Words
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Paths of some words, the row of each, and the languages of the rows."""
    for batch, data, offsets in hashing.parts(batches, 1, 4_000_000):
        found, ends, row, piece = pieces(data, offsets)
        langs = np.array(batch.column(0).to_pylist(), object)
        for low in range(0, len(ends), CHUNK):
            high = min(low + CHUNK + 2, len(ends))  # with the words that go on from the last ones
            start = ends[low - 1] if low else 0
            ids = words.ids(found[start : ends[high - 1]], ends[low:high] - start)
            n = min(CHUNK, len(ends) - low)
            yield _paths(ids, row[low:high], piece[low:high], n), row[low : low + n], langs


def _count(splitters: list[Splitter], burst: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, trie = _Words(), word_trie.Trie(burst, most)

        def spilled(share: float) -> Iterator[pa.RecordBatch]:
            listed = list(words.number)
            rows = [
                (part, lang, word_trie.dump(runs))
                for lang, whole in trie.spill(listed, share)
                for part, runs in word_trie.by_partition(lang, whole, splitters)
            ]
            if rows:
                part, lang, blob = zip(*rows, strict=True)
                columns = [pa.array(part, pa.int32()), pa.array(lang, pa.string()), pa.array(blob, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "lang", "run"])

        for paths, row, langs in _chunks(batches, words):
            mine = langs[row]
            for lang in dict.fromkeys(langs[np.unique(row)].tolist()):
                trie.add(lang, np.sort(word_trie.pack(paths[:, mine == lang])))
            if len(words.number) > word_trie.WORDS:
                yield from spilled(1.0)
                words.number.clear()  # the same object: _chunks numbers by it
            elif trie.full():
                yield from spilled(0.5)
        yield from spilled(1.0)
        hashing.give_back_memory()

    return run


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few paths of each document, evenly spaced."""
    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = np.frombuffer((text or "").encode(), np.uint8)
            found, ends, row, piece = pieces(data, np.array([0, len(data)]))
            if not len(ends):
                continue
            starts = np.concatenate([[0], ends[:-1]])
            at = _paths(np.arange(1, len(ends) + 1), row, piece, len(ends))
            step = -(-len(ends) // _SAMPLED_FROM_ONE)
            raw = found.tobytes()
            columns = [
                [raw[starts[i - 1] : ends[i - 1]][:_SPLITTER_BYTES] if i else b"" for i in level]
                for level in at[:, ::step].tolist()
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(columns[0]), pa.string()), *(pa.array(c, pa.binary()) for c in columns)],
                names=["lang", "a", "b", "c"],
            )


def splitters(texts: DataFrame, part_bytes: int = PART_BYTES) -> list[Splitter]:
    """Borders of the prefix partitions, by paths of a sample of documents; never a result.

    There are as many partitions as the session's shuffles have, or as the bytes of text ask for,
    and at most a tenth of MOST_SAMPLES.
    """
    spark = texts.sparkSession
    n, size = texts.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // part_bytes))
    parts = min(parts, MOST_SAMPLES // 10)
    wanted = min(SAMPLES * parts, MOST_SAMPLES)
    share = min(1.0, 2 * max(wanted / _SAMPLED_FROM_ONE, 500) / max(n, 1))
    some = texts.sample(share, seed=12) if share < 1 else texts
    rows = some.mapInArrow(_sampled, "lang string, a binary, b binary, c binary").distinct()
    rows = rows.orderBy(F.xxhash64("a", "b", "c", "lang")).limit(wanted).collect()
    paths = sorted({(r.lang.encode(), bytes(r.a), bytes(r.b), bytes(r.c)) for r in rows})
    places = np.linspace(0, len(paths), parts, endpoint=False).astype(int)[1:]
    return sorted({paths[i] for i in places.tolist() if 0 < i < len(paths)})


def _prefix_sums(
    part: int, lang: str, runs: word_trie.Runs, borders: list[Splitter], least: int
) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(words, phrases, f) of sequences in the partition: those of `least` at least, or cut by its borders."""
    (first, second, third), counts, words = runs.paths, runs.counts, runs.words
    ends = [s for s in borders[max(part - 1, 0) : part + 1] if s[0] == lang.encode()]
    names = pa.array(words, pa.binary())
    space = pa.scalar(b" ", pa.binary())

    def phrases(chosen: np.ndarray, f: np.ndarray, *levels: np.ndarray) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
        for low in range(0, len(chosen), BLOCK):
            at = chosen[low : low + BLOCK]
            parts = [names.take(pa.array(level[at] - 1)) for level in levels]
            whole = pc.binary_join_element_wise(*parts, space) if len(parts) > 1 else parts[0]
            yield len(levels), whole, f[low : low + BLOCK]

    yield 0, pa.array([b""], pa.binary()), np.array([counts.sum()])
    whole = np.flatnonzero((third > 0) & (counts >= least))
    yield from phrases(whole, counts[whole], first, second, third)
    for levels, keys in (((first, second), first << 32 | second), ((first,), first)):
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        sums = np.add.reduceat(counts, starts)
        kept = sums >= least
        for cut in {s[1 : len(levels) + 1] for s in ends}:
            at = [bisect_left(words, w) for w in cut]
            if all(i < len(words) and words[i] == w for i, w in zip(at, cut, strict=True)):
                kept |= keys[starts] == (at[0] + 1 << 32 | at[1] + 1 if len(at) > 1 else at[0] + 1)
        if len(levels) > 1:
            kept &= second[starts] > 0
        yield from phrases(starts[kept], sums[kept], *levels)


def phrase_counts(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    least: int = LEAST,
    part_bytes: int = PART_BYTES,
    burst: int = 1 << 14,
    most: int = 1_000_000,
) -> DataFrame:
    """Rows (lang, words, phrase, f): how often phrases of 1 to 3 words occur, `least` times or more.

    A row of 0 words has the number of all words of the language. A-Z are lowered; texts are
    split at .,;:!? and line ends into pieces, and these at spaces and tabs into words; a phrase
    lies within a piece, and overlapping occurrences count. Null texts have no words, and a null
    language is `und`. Rows with repeated or null ids all count; other columns play no part.
    """
    texts = docs.select(F.coalesce(lang_col, F.lit(NO_LANG)).alias("lang"), F.col(text_col).alias("text"))
    borders = splitters(texts, part_bytes)
    runs = texts.mapInArrow(_count(borders, burst, most), _RUNS)

    def merge(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blobs = key[0].as_py(), {}
        for batch in rows:
            for lang, blob in zip(batch["lang"].to_pylist(), batch["run"].to_pylist(), strict=True):
                blobs.setdefault(lang, []).append(blob)
        for lang in sorted(blobs):
            runs = word_trie.merged(blobs.pop(lang))
            for n_words, phrases, f in _prefix_sums(part, lang, runs, borders, least):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(f), pa.string()),
                        pa.array(np.full(len(f), n_words, np.int32)),
                        phrases,
                        pa.array(f, pa.int64()),
                    ],
                    names=["lang", "words", "phrase", "f"],
                )
            del runs
        hashing.give_back_memory()

    partial = runs.groupBy("part").applyInArrow(merge, _COUNTS)
    # Only sequences that a border cuts, and totals, come from more than one partition.
    return (
        partial.groupBy("lang", "words", F.col("phrase").cast("string").alias("phrase"))
        .agg(F.sum("f").alias("f"))
        .filter((F.col("f") >= least) | (F.col("words") == 0))
    )


def _looked_up(rows: DataFrame, counts: DataFrame, total: int, part: str, name: str) -> DataFrame:
    """rows with the count of their (lang, part); keys of very many rows are dealt by salt."""
    limit = max(HOT_ROWS, total // 1_000)
    hot = (
        rows.groupBy("lang", part)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > limit)  # at most 1,000 keys
        .select("lang", part, F.ceil(F.col("n") / limit).alias("fan"))
    )
    fan = F.coalesce("fan", F.lit(1))
    known = counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    keys = ["lang", part]
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn("salt", F.pmod(F.xxhash64("phrase"), fan))
    copied = known.join(F.broadcast(hot), keys, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), fan - 1))
    )
    return dealt.drop("fan").join(copied.drop("fan"), [*keys, "salt"]).drop("salt")


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(14,0)")


def scored(counts: DataFrame) -> DataFrame:
    """Rows (lang, words, phrase, a, l, r, score) of phrases of 2 and 3 words, at the cut that scores least.

    score = floor(1000000 a a / (l r)) in exact arithmetic, for counts below 10^14.
    """
    phrases = counts.filter("words >= 2").withColumnRenamed("f", "a")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn(
        "rest", F.expr("substr(phrase, length(first) + 2)")
    )
    total = cuts.count()
    parts = counts.filter("words BETWEEN 1 AND 2")
    both = _looked_up(_looked_up(cuts, parts, total, "first", "l"), parts, total, "rest", "r")
    rows = both.withColumns(
        {"ad": _exact("a"), "ld": _exact("l"), "rd": _exact("r")}
    ).withColumn("score", F.expr("(CAST(1000000 AS decimal(7,0)) * ad * ad) div (ld * rd)"))
    least = F.min(F.struct("score", "k", "l", "r")).alias("m")
    return (
        rows.groupBy("lang", "words", "phrase", "a")
        .agg(least)
        .select("lang", "words", "phrase", "a", "m.l", "m.r", "m.score")
    )


def covered(counts: DataFrame) -> DataFrame:
    """Rows (lang, phrase, longer): pairs inside a phrase of three words, and the most that one occurs."""
    pair = F.explode(
        F.array(F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2))
    ).alias("phrase")
    longer = counts.filter("words = 3").select("lang", "f", pair)
    return longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, **options) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language.

    See phrase_counts for texts and words, and scored for a, l, r and the score; n is the number
    of all words of the language. Pairs that lie in a phrase of three words which occurs at
    least half as often are dropped. Order: score and a descending, phrase ascending by its bytes.
    The counts are written to the folder of spark.checkpoint.dir once.
    """
    counts = materialize(phrase_counts(docs, least=least, **options), "phrases")
    rows = scored(counts).join(covered(counts), ["lang", "phrase"], "left")
    rows = rows.filter(F.col("longer").isNull() | (100 * F.col("longer") < 50 * F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within salts, so that no task meets the best rows of all others.
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))).orderBy(*order)
    some = rows.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    totals = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    return (
        ranked.filter(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
