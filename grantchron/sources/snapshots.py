"""Changes between two snapshots, and what an updated_at extract misses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from grantchron.functions.times import at
from grantchron.operators.checks import fingerprints

SLOT = "__bucket"


def diff_snapshots(old: DataFrame, new: DataFrame, key, capture_ns: int) -> DataFrame:
    """Create, update and hard-delete events that lead from old to new.

    A delete carries its key only. Unchanged rows give no event.
    """
    key = list(key)
    values = [c for c in new.columns if c not in key]
    before = old.select(*key, F.struct(*values).alias("__before"))
    after = new.select(*key, F.struct(*values).alias("__after"))
    b, a = F.col("__before"), F.col("__after")
    op = F.when(b.isNull(), "c").when(a.isNull(), "d").when(~b.eqNullSafe(a), "u")
    return (
        before.join(after, key, "full_outer")
        .withColumn("__op", op)
        .filter("__op IS NOT NULL")
        .select(
            *key,
            *[a[c].alias(c) for c in values],
            "__op",
            F.lit(capture_ns).cast("long").alias("__source_ts_ns"),
        )
    )


def save_snapshot(table: DataFrame, name: str, key, buckets: int, path: str | None = None) -> None:
    """A snapshot as a table bucketed and sorted by key, and a table of its buckets' fingerprints.

    A bucket is a folder of its own, so that equal ones need not be read. Snapshots that are to be
    compared have the same number of buckets; it is about rows / 1-2 million.
    """
    spark, key = table.sparkSession, list(key)
    slotted = table.withColumn(SLOT, F.pmod(F.hash(*key), F.lit(buckets)))
    writer = slotted.repartition(buckets, *key).write.partitionBy(SLOT).bucketBy(buckets, *key).sortBy(*key)
    if path:
        writer = writer.option("path", path)
    writer.mode("overwrite").saveAsTable(name)
    prints = fingerprints(spark.table(name), SLOT).coalesce(1).write.mode("overwrite")
    if path:
        prints = prints.option("path", f"{path.rstrip('/')}_prints")
    prints.saveAsTable(f"{name}_prints")


def unequal_buckets(spark: SparkSession, old: str, new: str) -> list[int]:
    """The buckets of two saved snapshots with other fingerprints, or that one of them lacks."""
    before, after = (spark.table(f"{name}_prints") for name in (old, new))
    odd = before.exceptAll(after).unionByName(after.exceptAll(before))
    return sorted({r[SLOT] for r in odd.select(SLOT).collect()})  # at most the buckets there are


def diff_stored(spark: SparkSession, old: str, new: str, key, capture_ns: int) -> DataFrame:
    """S5 between saved snapshots: only buckets that differ are read, and none is shuffled."""
    odd = unequal_buckets(spark, old, new)
    sides = (spark.table(name).filter(F.col(SLOT).isin(odd)).drop(SLOT) for name in (old, new))
    return diff_snapshots(*sides, key, capture_ns)


def incremental_extract(table: DataFrame, since, updated_at: str = "updated_at") -> DataFrame:
    """What a job that asks for recently updated rows would see."""
    return table.filter(F.col(updated_at) > at(since))


def missed_changes(changes: DataFrame, extract: DataFrame, key) -> DataFrame:
    """Captured changes whose key the extract does not show."""
    return changes.join(extract.select(*key), list(key), "left_anti")


def apply_changes(table: DataFrame, changes: DataFrame, key) -> DataFrame:
    """The table after one insert, update or delete per changed key."""
    key = list(key)
    values = [c for c in table.columns if c not in key]
    touched = changes.select(*key, F.struct(*values).alias("__new"), F.col("__op"))
    stored = table.select(*key, F.struct(*values).alias("__old"))
    result = F.when(F.col("__op").isNull(), F.col("__old")).otherwise(F.col("__new"))
    return (
        stored.join(touched, key, "full_outer")
        .filter("__op IS NULL OR __op <> 'd'")
        .select(*key, result.alias("v"))
        .select(*key, "v.*")
    )


def require_rows(df: DataFrame, least: int) -> None:
    """Refuse to go on from a log that holds fewer rows; each task counts its own."""
    found = df.count()
    if found < least:
        raise RuntimeError(f"expected at least {least} rows, found {found}")


def missing_rows(source: DataFrame, target: DataFrame, key) -> DataFrame:
    """Source rows whose key the target lacks; appending them twice adds nothing."""
    return source.join(target.select(*key), list(key), "left_anti")


def seed_missing(source: DataFrame, target_path: str, key) -> None:
    """S12 on a stored table."""
    target = source.sparkSession.read.schema(source.schema).parquet(target_path)
    missing_rows(source, target, key).write.mode("append").parquet(target_path)
