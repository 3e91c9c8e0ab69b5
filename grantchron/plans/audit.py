"""Audits that read what has changed: of a store by the prints its commits keep (V1, V3), of a
bronze log by day (V4).

A print says of a part of a table, in any order of its rows, how many there are and what two
hashes of them add up to. Parts with equal prints are taken to be equal and are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from grantchron.model import FACT_TABLE, HISTORY_TABLE
from grantchron.operators import checks
from grantchron.operators.temporal import active_access
from grantchron.plans.store import Commit, GoldStore, added_up
from grantchron.sources.bronze import read_bronze

Print = list  # rows, sum1, sum2, and of current rows how many are active


def prints_after(store: GoldStore, before: Commit, after: Commit, batch: str) -> dict[str, dict[str, Print]]:
    """The prints of a commit whose batch is written, from those of the one before."""
    revoked, soft = store.spec.revoked_at, store.spec.soft_delete
    active = F.count_if(F.col(revoked).isNull() & ~F.col(soft))
    fact = store.current(after, [b for b, at in after.current.items() if at == batch])
    found = [_named("current", checks.fingerprints(_with_bucket(store, fact), "part", active=active))]
    opened = store.open_periods(after, [b for b, at in after.open.items() if at == batch])
    none = F.lit(0).cast("long")
    found.append(_named("open", checks.fingerprints(_with_bucket(store, opened), "part", active=F.max(none))))
    closed = store.closed_periods(after, [b for b in after.closed if b == batch])
    closed = closed.drop("end_day").withColumn("part", F.lit(batch))
    found.append(_named("closed", checks.fingerprints(closed, "part", active=F.max(none))))
    rows = reduce(DataFrame.unionByName, found).collect()  # at most a row for each bucket, twice, and one
    made: dict[str, dict[str, Print]] = {"current": {}, "open": {}, "closed": {}}
    for r in rows:
        made[r["table"]][r["part"]] = [r["rows"], str(r["sum1"]), str(r["sum2"]), r["active"]]
    written = {"current": after.current, "open": after.open, "closed": dict.fromkeys(after.closed, None)}
    empty = [0, "0", "0", 0]
    result = {}
    for table, parts in written.items():
        old = before.prints.get(table, {})
        new = {p: made[table].get(p, empty) for p, at in parts.items() if batch in (at, p)}
        result[table] = {**{p: old[p] for p in parts if p in old}, **new}
    return result


def _with_bucket(store: GoldStore, rows: DataFrame) -> DataFrame:
    return rows.withColumn("part", store.bucket())


def _named(table: str, prints: DataFrame) -> DataFrame:
    return prints.withColumn("table", F.lit(table))


def sizes(commit: Commit) -> dict[str, int]:
    """V3: rows of the tables at a commit, by its prints alone."""
    rows = {t: sum(p[0] for p in parts.values()) for t, parts in commit.prints.items()}
    return {
        "bronze": commit.events,
        FACT_TABLE: rows.get("current", 0),
        HISTORY_TABLE: rows.get("open", 0) + rows.get("closed", 0),
        "current_active_access": sum(p[3] for p in commit.prints.get("current", {}).values()),
    }


@dataclass(frozen=True)
class Changed:
    """The parts of a table that differ: those that both commits have, and of closed periods which."""

    known: int  # rows of parts that only one of the commits has: they all differ
    buckets: list[str]
    closed_before: list[str]
    closed_after: list[str]

    @property
    def to_read(self) -> bool:
        return bool(self.buckets or (self.closed_before and self.closed_after))


def _unequal(before: dict[str, Print], after: dict[str, Print]) -> tuple[int, list[str]]:
    alone = sum(p[0] for parts, other in ((before, after), (after, before)) for k, p in parts.items() if k not in other)
    return alone, sorted(k for k in before.keys() & after.keys() if before[k][:3] != after[k][:3])


def changed_parts(before: Commit, after: Commit) -> dict[str, Changed]:
    """V1: for the current-state table and the history, what of two commits has to be compared."""
    a, b = before.prints, after.prints
    known, buckets = _unequal(a.get("current", {}), b.get("current", {}))
    found = {FACT_TABLE: Changed(known, buckets, [], [])}
    known, buckets = _unequal(a.get("open", {}), b.get("open", {}))
    gone = {k: p for k, p in a.get("closed", {}).items() if k not in b.get("closed", {})}
    new = {k: p for k, p in b.get("closed", {}).items() if k not in a.get("closed", {})}
    if added_up(gone.values()) == added_up(new.values()):  # gathered into other files
        gone, new = {}, {}
    elif not (gone and new):
        known += added_up([*gone.values(), *new.values()])[0]
        gone, new = (gone, {}) if gone else ({}, new)
    found[HISTORY_TABLE] = Changed(known, buckets, sorted(gone), sorted(new))
    return found


def differences(store: GoldStore, before: Commit, after: Commit, table: str) -> DataFrame:
    """V1: the rows that only one of two commits has, of the parts that both have with other prints."""
    part = changed_parts(before, after)[table]
    if table == FACT_TABLE:
        return checks.differences(store.current(before, part.buckets), store.current(after, part.buckets))
    sides = []
    for commit, batches in ((before, part.closed_before), (after, part.closed_after)):
        batches = batches if part.closed_before and part.closed_after else []
        closed = store.closed_periods(commit, batches).drop("end_day")
        sides.append(closed.unionByName(store.open_periods(commit, part.buckets)))
    return checks.differences(*sides)


def changed_rows(store: GoldStore, before: Commit, after: Commit) -> dict[str, int]:
    """V1: for each table how many rows only one of two commits has; equal parts are not read."""
    return {
        table: part.known + (differences(store, before, after, table).count() if part.to_read else 0)
        for table, part in changed_parts(before, after).items()
    }


# -- bronze, by day ----------------------------------------------------------------------


def day_files(spark: SparkSession, path: str) -> DataFrame:
    """For each capture day what tells its files apart: names, lengths, times. No file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    day = F.regexp_extract("path", "/capture_day=([^/]+)/", 1).try_cast("date")
    return (
        files.filter(F.col("path").endswith(".parquet"))
        .select(day.alias("capture_day"), F.xxhash64("path", "length", "modificationTime").alias("file"))
        .groupBy("capture_day")
        .agg(F.sum(F.col("file").cast("decimal(20,0)")).cast("decimal(38,0)").alias("files"))
    )


def day_prints(spark: SparkSession, path: str, schema, known: DataFrame | None = None) -> DataFrame:
    """V4: rows (capture_day, files, rows, sum1, sum2) of a log; known: those found before.

    Only days whose files are not as they were then are read.
    """
    now = day_files(spark, path)
    log = read_bronze(spark, path, schema)
    if known is None:
        fresh = checks.fingerprints(log, "capture_day")
        return now.join(fresh, now["capture_day"].eqNullSafe(fresh["capture_day"])).select(now["*"], *_SUMS)
    old = known.select(F.col("capture_day").alias("d"), F.col("files").alias("f"), *_SUMS)
    same = now["capture_day"].eqNullSafe(old["d"]) & (now["files"] == old["f"])
    touched = now.join(old, same, "left_anti")
    days = [r["capture_day"] for r in touched.select("capture_day").collect()]  # days, not rows
    kept = now.join(old, same).select(now["*"], *_SUMS)
    if not days:
        return kept
    chosen = F.col("capture_day").isin([d for d in days if d is not None])
    if None in days:
        chosen = F.coalesce(chosen, F.lit(True))
    fresh = checks.fingerprints(log.filter(chosen), "capture_day").withColumnRenamed("capture_day", "d")
    again = touched.join(fresh, touched["capture_day"].eqNullSafe(F.col("d")))
    return kept.unionByName(again.select(touched["*"], *_SUMS))


_SUMS = ("rows", "sum1", "sum2")


def broken_days(before: DataFrame, appended: DataFrame, after: DataFrame) -> DataFrame:
    """V4: days whose rows are not those of before and those appended, by their prints.

    appended: the rows added since, with capture_day. Rows (capture_day, expected, found).
    """
    added = checks.fingerprints(appended, "capture_day")
    wanted = before.select("capture_day", *_SUMS).unionByName(added.select("capture_day", *_SUMS))
    wanted = wanted.groupBy("capture_day").agg(*[F.sum(c).cast(_TYPES[c]).alias(f"w_{c}") for c in _SUMS])
    wanted = wanted.withColumnRenamed("capture_day", "w_day")
    joined = wanted.join(after, F.col("w_day").eqNullSafe(after["capture_day"]), "full_outer")
    equal = reduce(lambda a, b: a & b, [F.col(f"w_{c}").eqNullSafe(F.col(c)) for c in _SUMS])
    return joined.filter(~equal).select(
        F.coalesce("capture_day", "w_day").alias("capture_day"),
        F.col("w_rows").alias("expected"),
        F.col("rows").alias("found"),
    )


_TYPES = {"rows": "long", "sum1": "decimal(38,0)", "sum2": "decimal(38,0)"}
