"""Exact deduplication (9): local, then salted, then global winners, by digest and content."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

SALTS = 32


def normalised(text: str | Column) -> Column:
    """The text with each run of space, tab and line ends as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """Rows (id_col, keep_id, group_size, kept, text_sha256), one for each row of docs.

    Rows are in a group if their normalised texts are the same; the smallest id stays (a null id
    only in a group without others). Each task merges its own copies (partial aggregation), then
    copies meet within (digest, salt), then salt winners within the digest; all three compare
    the whole text, not the digest alone, so texts that share a digest stay apart (should they
    share the second one as well, the job fails rather than mix them). Rows find their winner by (digest, salt) again, so
    that no group of copies is in one task. Null text is empty text; if an id repeats within
    the group and is the smallest, all its rows are kept. Other columns of docs are left out.
    """
    text = normalised(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        text.alias("content"),
        F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int").alias("salt"),
    ).withColumns({"digest": digest(F.col("content")), "check": F.xxhash64("content")})

    salted = rows.groupBy("digest", "check", "salt", "content").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    winners = salted.groupBy("digest", "check", "content").agg(
        F.min("first").alias("keep_id"),
        F.sum("n").alias("group_size"),
        F.collect_set("salt").alias("salts"),  # at most `salts`
    )
    places = (
        winners.select("digest", "check", "keep_id", "group_size", F.explode("salts").alias("salt"))
        .groupBy("digest", "check", "salt")
        .agg(
            F.min("keep_id").alias("keep_id"),
            F.min("group_size").alias("group_size"),
            F.count(F.lit(1)).alias("texts"),
        )
        .withColumn("group_size", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
            F.raise_error(F.lit("two texts share both digests")).cast("long")
        ))
        .drop("texts")
    )
    return rows.drop("content").join(places, ["digest", "check", "salt"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
