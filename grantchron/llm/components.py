"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _with_least(links: DataFrame) -> DataFrame:
    """Each link (a, b) with the least of all b of its a."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    return links.join(least, "a")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component): the least node reachable, for each node of a link.

    Every round links each node's larger neighbours to its least one, then each node and its
    smaller neighbours to the least of them, until nothing changes; the links then form stars.
    A node's neighbours are never gathered: a round is minimums and joins by key. Rounds are
    checkpointed to the folder of spark.checkpoint.dir. Null ends and links of a node to itself
    name no component of their own beside that node.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna()
    links = links.filter("a != b").distinct()
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            _with_least(both)
            .filter("b > a")
            .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
            .distinct()
        )
        tied = _with_least(large)
        small = (
            tied.filter("b != least")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .unionByName(tied.select("a", F.col("least").alias("b")))
            .distinct()
        )
        links = small.checkpoint()
        after = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if after == before:
            break
        before = after
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = stars.select("component").distinct()
    return stars.unionByName(centres.select(F.col("component").alias("node"), "component"))
