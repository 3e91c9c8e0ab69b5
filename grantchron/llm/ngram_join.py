"""N-gram Jaccard join (1): MinHash bands, blocks within large bands, exact checks on full sets.

Documents with equal n-gram sets are one class, found by a 128-bit digest of the set. One
document of each class goes on: bands of its signature meet by hash; within a band of one hash,
all pairs of different classes are checked on their full sets, a pair only in its first common
band. A band that holds many is split into chunks, and pairs of chunks are tasks of their own.
Tasks give each document its number of links and a link to the least document it is joined
with there, so pairs are never listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from grantchron.llm.components import components
from grantchron.llm.hashing import U64, bytes_of, mix, parts, place_in_row, runs, word_hashes, words

N, THRESHOLD = 5, 0.8
RECALL = 0.9999  # of pairs at the threshold; those above it have more
MOST_HASHES = 128
SALTS = 16  # parts of a class of copies
CHUNK = 512  # documents of a band that one task compares with as many others


def bands_and_rows(
    threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = MOST_HASHES
) -> tuple[int, int]:
    """The most rows a band, and so the fewest chance meetings, for which bands reach the recall.

    A pair of similarity s shares one of b bands of r rows with probability 1 - (1 - s**r)**b.
    """
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > hashes:
            break
        best = bands, rows
    return best


def ngrams(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each different n-gram; the words of a row with fewer than n make one."""
    starts, stops, before = words(data, offsets)
    hashes = word_hashes(data, starts, stops)
    row, place = place_in_row(before, len(starts))
    count = np.diff(before)
    rolled = runs(hashes, n)
    whole = np.flatnonzero(place[: len(rolled)] + n <= count[row[: len(rolled)]])
    short = np.flatnonzero((count > 0) & (count < n))
    few = [mix(runs(hashes[before[r] : before[r + 1]], int(count[r]))) for r in short]
    rows = np.concatenate((row[whole], short))
    grams = np.concatenate((rolled[whole], *few)) if few else rolled[whole]
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    new = np.ones(len(rows), bool)
    new[1:] = (np.diff(rows) != 0) | (np.diff(grams) != 0)
    return rows[new], grams[new]


def _signatures(n: int, bands: int, rows: int):
    ones = np.arange(1, bands * rows + 1, dtype=U64)
    factors, terms = mix(ones) | U64(1), mix(ones + U64(1 << 32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in parts(batches, 1):
            row, grams = ngrams(data, offsets, n)
            edges, d1, d2 = _digests(row, grams)
            full = row[edges]
            band = np.zeros((len(full), bands), U64)
            for i in range(bands * rows if len(full) else 0):
                least = np.minimum.reduceat((grams * factors[i] + terms[i]) >> U64(32), edges)
                band[:, i // rows] = mix(band[:, i // rows] ^ least ^ U64(i))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(full)),
                    pa.array(d1),
                    pa.array(d2),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(full) + 1) * bands, pa.int32()),
                        pa.array(band.view(np.int64).reshape(-1)),
                    ),
                ],
                names=["id", "d1", "d2", "bands"],
            )

    return run


def _digests(row: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each row's n-grams start, and two sums over the set."""
    edges = np.flatnonzero(np.diff(row, prepend=-1))
    if not len(edges):
        return edges, np.empty(0, np.int64), np.empty(0, np.int64)
    sums = (np.add.reduceat(mix(grams ^ U64(c)), edges).view(np.int64) for c in (0, 0xABCDEF))
    return edges, *sums


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compress = zstandard.ZstdCompressor(level=1).compress
    for b in batches:
        texts = [compress(t.encode()) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(texts, pa.binary())], names=["id", "packed"]
        )


def _with_digest(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inflate = zstandard.ZstdDecompressor().decompress
        for b in batches:
            texts = pa.array([inflate(t) for t in b.column(1).to_pylist()], pa.binary())
            data, offsets = bytes_of(texts)
            _, d1, d2 = _digests(*ngrams(data, offsets, n))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(d1), pa.array(d2), b.column(1)],
                names=["id", "d1", "d2", "packed"],
            )

    return run


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each of left shares with each of right."""
    result = np.zeros((len(left), len(right)), np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(a, b)
    row_a = np.repeat(np.arange(len(left)), [len(x) for x in left])
    row_b = np.repeat(np.arange(len(right)), [len(x) for x in right])
    at_a, at_b = np.searchsorted(shared, a), np.searchsorted(shared, b)
    step = 4096  # n-grams of the matrices that are multiplied
    in_a = np.flatnonzero(np.isin(a, shared))
    in_b = np.flatnonzero(np.isin(b, shared))
    in_a, in_b = in_a[np.argsort(at_a[in_a])], in_b[np.argsort(at_b[in_b])]
    col_a, col_b = at_a[in_a], at_b[in_b]
    for low in range(0, len(shared), step):
        s = slice(*np.searchsorted(col_a, (low, low + step)))
        t = slice(*np.searchsorted(col_b, (low, low + step)))
        x = np.zeros((len(left), min(step, len(shared) - low)), np.float32)
        y = np.zeros((len(right), x.shape[1]), np.float32)
        x[row_a[in_a[s]], col_a[s] - low] = 1
        y[row_b[in_b[t]], col_b[t] - low] = 1
        result += (x @ y.T).astype(np.int64)
    return result


def _least_joined(n: int, pairs: np.ndarray) -> np.ndarray:
    """For each of n entries the least one that pairs join it with."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in pairs.tolist():
        i, j = find(i), find(j)
        root[max(i, j)] = min(i, j)
    return np.array([find(i) for i in range(n)])


def _sets(packed: pa.ChunkedArray, n: int, size: int = 2_000_000) -> list[np.ndarray]:
    """The n-grams of each text, of some `size` bytes of text at a time."""
    inflate = zstandard.ZstdDecompressor().decompress
    sets: list[np.ndarray] = []
    texts: list[bytes] = []
    left = len(packed)
    for blob in packed:
        texts.append(inflate(blob.as_py()))
        left -= 1
        if not left or sum(map(len, texts)) >= size:
            offsets = np.cumsum([0, *map(len, texts)])
            row, grams = ngrams(np.frombuffer(b"".join(texts), np.uint8), offsets, n)
            sets += np.split(grams, np.searchsorted(row, np.arange(1, len(texts))))
            texts = []
    return sets


_LINKS = "id long, n_links long, least long"


def _compare(n: int, threshold: float):
    """For a band's bucket, or two chunks of one: links of its documents among them."""

    def run(table: pa.Table) -> pa.Table:
        band, left, right = (table[c][0].as_py() for c in ("band", "left", "right"))
        order = np.argsort(table["id"].to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        ids, sizes, chunk = (table[c].to_numpy() for c in ("id", "class_size", "chunk"))
        bands = np.array(table["bands"].to_pylist(), np.int64)
        sets = _sets(table["packed"], n)
        a, b = np.flatnonzero(chunk == left), np.flatnonzero(chunk == right)
        none = pa.table([pa.array([], pa.int64())] * 3, names=["id", "n_links", "least"])
        if not len(a) or not len(b):
            return none
        common = _common([sets[i] for i in a], [sets[j] for j in b])
        size = np.array([len(s) for s in sets])
        union = size[a][:, None] + size[b][None, :] - common
        linked = common / union >= threshold
        for k in range(band):  # pairs that meet in an earlier band count there
            linked &= bands[a, k][:, None] != bands[b, k][None, :]
        if left == right:
            linked = np.triu(linked, 1)
        i, j = np.nonzero(linked)
        if not len(i):
            return none
        i, j = a[i], b[j]
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, i, sizes[j])
        np.add.at(links, j, sizes[i])
        least = _least_joined(len(ids), np.stack((i, j), 1))
        met = np.flatnonzero(links)
        return pa.table(
            [pa.array(ids[met]), pa.array(links[met]), pa.array(ids[least[met]])],
            names=["id", "n_links", "least"],
        )

    return run


def ngram_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = N,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    chunk: int = CHUNK,
) -> DataFrame:
    """Rows (id_col, class_id, n_links, component_id, kept), one for each row of docs.

    Two documents are linked if the sets of their n-grams of words (runs of characters other
    than space, tab and line ends, as written) have a Jaccard similarity of `threshold` or more;
    a pair at the threshold is found with probability `recall`, nearer ones more surely, and
    none below it is linked. `class_id` is the least id with the same set, `n_links` the number
    of other rows linked directly, `component_id` the least id that links reach; `kept` says
    that it is the row's own.

    A text of fewer than n words has one n-gram, all of it. Null or empty texts, and rows with a
    null id, are linked with nothing: their class and component are their own id. Ids are
    integers; rows that agree in both count as linked with each other, and all stay or go. Of
    different texts that share an id, the one whose set has the least digest is compared with
    other classes. Other columns of docs are left out.
    """
    bands, rows = bands_and_rows(threshold, recall)
    own = F.col(id_col).cast("long").alias("id")
    texts = docs.select(own, F.col(text_col).alias("text"))
    useful = texts.filter(F.col("id").isNotNull() & F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    signed = (
        useful.mapInArrow(
            _signatures(n, bands, rows), "id long, d1 long, d2 long, bands array<long>"
        )
        .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
        .checkpoint()
    )
    # Copies meet by salt first, and find their class by salt again: no class is in one task.
    classes = (
        signed.groupBy("d1", "d2", "salt")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .groupBy("d1", "d2")
        .agg(
            F.min("first").alias("class_id"),
            F.sum("n").alias("class_size"),
            F.collect_set("salt").alias("salts"),  # at most SALTS
        )
        .checkpoint()
    )

    def of_rows(of_classes: DataFrame) -> DataFrame:
        """The rows of signed with what their class has."""
        spread = of_classes.withColumn("salt", F.explode("salts")).drop("salts")
        return signed.join(spread, ["d1", "d2", "salt"])

    # One row of each class, and one of each id.
    heads = (
        of_rows(classes)
        .filter("id = class_id")
        .groupBy("id")
        .agg(F.min_by(F.struct("d1", "d2", "bands", "class_size"), F.struct("d1", "d2")).alias("head"))
        .select("id", "head.*")
    )
    placed = heads.select("id", F.posexplode("bands").alias("band", "hash"))
    crowds = (
        placed.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    met = placed.join(crowds, ["band", "hash"]).withColumn("chunks", F.ceil(F.col("n") / chunk))
    wanted = met.select("id").distinct()
    contents = (
        useful.mapInArrow(_packed, "id long, packed binary")
        .join(wanted, "id", "left_semi")
        .mapInArrow(_with_digest(n), "id long, d1 long, d2 long, packed binary")
    )
    compared_rows = heads.join(contents, ["id", "d1", "d2"]).dropDuplicates(["id"])
    k = F.col("chunk")
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
        lambda c: F.struct(F.least(c, k).alias("left"), F.greatest(c, k).alias("right")),
    )
    compared = (
        met.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")))
        .join(compared_rows, "id")
        .select("*", F.explode(pairs).alias("pair"))
        .select("band", "hash", "pair.left", "pair.right", "id", "chunk", "class_size", "bands", "packed")
        .groupBy("band", "hash", "left", "right")
        .applyInArrow(_compare(n, threshold), _LINKS)
        .groupBy("id", "least")
        .agg(F.sum("n_links").alias("n_links"))
        .checkpoint()
    )
    parts_of = components(compared.select("id", "least"), "id", "least")
    links = compared.groupBy(F.col("id").alias("class_id")).agg(F.sum("n_links").alias("others"))
    found = of_rows(
        classes.join(links, "class_id", "left").join(
            parts_of.withColumnRenamed("node", "class_id"), "class_id", "left"
        )
    ).select(
        "id",
        "class_id",
        (F.col("class_size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "class_id").alias("component_id"),
    )
    alone = texts.filter(
        ~(F.col("id").isNotNull() & F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    ).select(
        "id",
        F.col("id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.col("id").alias("component_id"),
    )
    return found.unionByName(alone).select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col),
        "class_id",
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
