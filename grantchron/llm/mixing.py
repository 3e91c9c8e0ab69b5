"""Mixing sources to target weights (5) by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

import heapq
from itertools import cycle

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

WEIGHTS = (5, 2, 1)
MOST = 3  # a source, and each of its documents, is taken at most so many times
BLOCK = 8  # words in a block; what a source gets is within about a block of its target
SHARD_ROWS = 5_000  # about as many documents of a source are laid end to end in one task
BROADCAST_SOURCES = 50_000  # with more sources than that, their table is joined by shuffling


def words(text: str | Column) -> Column:
    """Number of runs of characters other than space, tab and line ends; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights: tuple = WEIGHTS) -> dict[str | None, float]:
    """Words wanted of each source, which sum to all words.

    Weights go round over the sources by code point, null last. A target stops at MOST times
    the source's size; what is left over is shared anew by weight among the others.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = dict(zip(order, cycle(weights), strict=False))
    result, left, open_sources = {}, float(sum(sizes.values())), order
    while open_sources:
        share = left / sum(weight[s] for s in open_sources)
        full = [s for s in open_sources if share * weight[s] > MOST * sizes[s]]
        if not full:
            return result | {s: share * weight[s] for s in open_sources}
        result |= {s: float(MOST * sizes[s]) for s in full}
        left -= sum(MOST * sizes[s] for s in full)
        open_sources = [s for s in open_sources if s not in result]
    return result


def sainte_lague(shares: list[float], seats: int, most: list[int]) -> list[int]:
    """Seats by the highest quotients share / (2k + 1); none gets more than `most`, ties go first.

    The seats that any result has (share / divisor, rounded, at a divisor a little too high)
    are given at once; the rest, about one for each share, one by one.
    """
    total = sum(shares)
    given = [0] * len(shares)
    if total <= 0 or seats <= 0:
        return given
    sure = max(0, seats - len(shares))
    given = [min(m, int(s * sure / total)) for s, m in zip(shares, most, strict=True)]
    heap = [
        (-s / (2 * g + 1), i)
        for i, (s, g, m) in enumerate(zip(shares, given, most, strict=True))
        if g < m and s > 0
    ]
    heapq.heapify(heap)
    for _ in range(seats - sum(given)):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        given[i] += 1
        if given[i] < most[i]:
            heapq.heappush(heap, (-shares[i] / (2 * given[i] + 1), i))
    return given


def _shard_quotas(block: int):
    """For the shards of one source (a row for each SHARD_ROWS documents): their blocks."""

    def run(shards: pd.DataFrame) -> pd.DataFrame:
        shards = shards.sort_values("shard")
        words_of = [int(w) for w in shards["shard_words"]]
        most = [-(-MOST * w // block) for w in words_of]
        quota = int(shards["quota"].iloc[0])
        shards["blocks"] = sainte_lague([float(w) for w in words_of], quota, most)
        return shards.drop(columns="quota")

    return run


def mix(
    docs: DataFrame,
    seed: int = 0,
    weights: tuple = WEIGHTS,
    block: int = BLOCK,
    shard_rows: int = SHARD_ROWS,
    id_col: str = "doc_id",
    source_col: str = "source",
    size: Column | None = None,
) -> DataFrame:
    """The columns of docs, and size, source_size, target, taken, copies for each row.

    `size` is the words of a row, by default those of its column text.

    All words are cut into blocks of `block` words; sources get blocks by Sainte-Laguë over
    their targets (`targets`), then shards of a source (by hash of the id) over their words. A
    shard's documents stand in an order drawn by seed and id; its blocks are whole rounds over
    the shard and then the blocks that follow a drawn one, round the end if need be. `taken`
    is the number of a document's words in them, repeats counted, at most MOST times its
    size. `copies` is how often the block with its first word is taken: what a mix of whole
    documents uses.

    Null or empty texts have size 0 and are taken 0 times. A null source is a source of its
    own, last in order. Rows with one id are ordered by all their columns, so that reruns agree. An
    empty table gives an empty one. New columns replace clashing ones of docs.
    """
    made = ("size", "source_size", "target", "taken", "copies")
    rows = docs.select(
        F.struct(*[c for c in docs.columns if c not in made]).alias("row"),
        F.coalesce(source_col, F.lit("")).alias("source_key"),
        F.col(source_col).isNull().alias("source_null"),
        F.coalesce(words("text") if size is None else size, F.lit(0)).alias("size"),
        F.col(id_col).alias("id"),
        F.xxhash64(*docs.columns).alias("tie"),
    )
    return _taken(rows, seed, weights, block, shard_rows).select(
        "row.*", "size", "source_size", "target", "taken", "copies"
    )


def _taken(rows: DataFrame, seed: int, weights: tuple, block: int, shard_rows: int) -> DataFrame:
    spark = rows.sparkSession
    of_source = (  # one row for each source
        rows.groupBy("source_key", "source_null")
        .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    sizes = {None if r.source_null else r.source_key: r.words for r in of_source}
    wanted = targets(sizes, weights)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    quotas = sainte_lague(
        [wanted[s] for s in order],
        round(sum(sizes.values()) / block),
        [-(-MOST * sizes[s] // block) for s in order],
    )
    quota = dict(zip(order, quotas, strict=True))
    plan = spark.createDataFrame(
        [
            (r.source_key, r.source_null, r.words, wanted[s], quota[s], -(-r.rows // shard_rows))
            for r in of_source
            for s in [None if r.source_null else r.source_key]
        ],
        "source_key string, source_null boolean, source_size long, target double, quota long, "
        "shards long",
    )
    if len(of_source) <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    source, shard = ["source_key", "source_null"], ["source_key", "source_null", "shard"]
    rows = rows.join(plan, source).withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")))
    by_shard = (
        rows.groupBy(*shard)
        .agg(F.sum("size").alias("shard_words"), F.first("quota").alias("quota"))
        .groupBy(*source)
        .applyInPandas(
            _shard_quotas(block),
            "source_key string, source_null boolean, shard long, shard_words long, blocks long",
        )
    )
    drawn = F.xxhash64(F.lit(seed), F.col("id"))
    line = Window.partitionBy(*shard).orderBy(drawn, "id", "size", "tie")
    length, n = F.col("shard_words"), F.col("taken_words")
    start, end = F.col("end") - F.col("size"), F.col("end")
    first = F.pmod(
        F.xxhash64(F.lit(seed), *shard), F.greatest(F.ceil(length / block), F.lit(1))
    ) * block
    upto = F.col("from") + F.col("rest")

    def overlap(low: Column, high: Column) -> Column:
        return F.greatest(F.least(end, high) - F.greatest(start, low), F.lit(0))

    def holds(low: Column, high: Column) -> Column:
        return ((start >= low) & (start < high) & (F.col("size") > 0)).cast("long")

    once = [F.col("from"), F.least(upto, length)], [F.lit(0), F.greatest(upto - length, F.lit(0))]
    return (
        rows.withColumn(
            "end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0))
        )
        .join(by_shard, shard)
        .withColumn("taken_words", F.least(F.col("blocks") * block, MOST * length))
        .withColumn("rounds", F.when(length > 0, F.expr("taken_words div shard_words")).otherwise(0))
        .withColumns({"rest": n - F.col("rounds") * length, "from": F.least(first, length)})
        .withColumn(
            "taken",
            F.col("rounds") * F.col("size") + overlap(*once[0]) + overlap(*once[1]),
        )
        .withColumn(
            "copies",
            F.when(F.col("size") > 0, F.col("rounds")).otherwise(0) + holds(*once[0]) + holds(*once[1]),
        )
    )
