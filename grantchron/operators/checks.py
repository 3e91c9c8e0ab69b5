"""Checks on logs and gold tables (V1-V9, A9). Each returns the offending rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from grantchron.model import GRANTS, ChangeSpec
from grantchron.operators.ordered import OrderedRuns
from grantchron.operators.temporal import PERIOD_ORDER, active_access


def duplicate_current(history: DataFrame, spec: ChangeSpec = GRANTS) -> DataFrame:
    """Keys with more than one current period."""
    return (
        history.filter("is_current")
        .groupBy(*spec.key)
        .agg(F.count(F.lit(1)).alias("current_version_count"))
        .filter("current_version_count > 1")
    )


def differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """V1: rows only one side has, as often as it has more of them."""
    after = after.select(*before.columns)
    return (
        before.exceptAll(after)
        .withColumn("side", F.lit("before"))
        .unionByName(after.exceptAll(before).withColumn("side", F.lit("after")))
    )


def fingerprints(df: DataFrame, *by: str | Column, **more: Column) -> DataFrame:
    """For each part of df, whatever the order of its rows: their number and two sums of hashes.

    Sums are exact, so those of parts that are put together add up. Nulls are hashed by place.
    """
    named = {b for b in by if isinstance(b, str)}
    own = sorted(c for c in df.columns if c not in named)
    nulls = [F.col(c).isNull() for c in own]

    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), *own, *nulls).cast("decimal(20,0)")).cast("decimal(38,0)")

    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        total(1).alias("sum1"),
        total(2).alias("sum2"),
        *[c.alias(n) for n, c in more.items()],
    )


def lost_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """V4: earlier bronze rows that a later bronze no longer holds."""
    return before.exceptAll(after.select(*before.columns))


def row_counts(**tables: DataFrame) -> DataFrame:
    """V3: one row per table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def missing_tables(spark: SparkSession, database: str, expected) -> list[str]:
    """V5: expected tables and views the database does not hold."""
    found = {t.name for t in spark.catalog.listTables(database)}
    return sorted(set(expected) - found)


def view_against_history(
    fact: DataFrame, history: DataFrame, spec: ChangeSpec = GRANTS
) -> DataFrame:
    """V6: keys active by the current-state view but not by history, or the reverse."""
    viewed = active_access(fact, spec).select(*spec.key, F.lit(True).alias("in_view"))
    open_now = history.filter("is_current").select(*spec.key, F.lit(True).alias("in_history"))
    return (
        viewed.join(open_now, list(spec.key), "full_outer")
        .na.fill(False, ["in_view", "in_history"])
        .filter("in_view <> in_history")
    )


def period_problems(
    history: DataFrame, spec: ChangeSpec = GRANTS, hot_limit: int | None = None
) -> DataFrame:
    """V7: periods that end before they start, are empty, or start before an earlier one ended.

    Of the key's earlier periods the one that reaches furthest counts, so periods within a long
    one are found, whatever lies between.
    """
    start, end = F.col("effective_start"), F.col("effective_end")
    rows = OrderedRuns(history, spec.key, PERIOD_ORDER, hot_limit).add(
        largest={"__reach": end, "__endless": end.isNull()}
    ).rows()
    problem = F.concat_ws(
        ",",
        F.when(end < start, F.lit("inverted")),
        F.when(end == start, F.lit("zero_length")),
        F.when(F.col("__endless") | (F.col("__reach") > start), F.lit("overlap")),
    )
    return rows.select(*history.columns, problem.alias("problem")).filter("problem <> ''")


def loaded_more_than_once(df: DataFrame) -> DataFrame:
    """V9: rows equal in every column, with how often they occur."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def tally(table: DataFrame, **values: Column) -> DataFrame:
    """Named aggregates of one table as (name, value) rows, in one pass."""
    named = [F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in values]
    return table.agg(*[c.cast("long").alias(n) for n, c in values.items()]).select(
        F.inline(F.array(*named))
    )


def assert_equal(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """V2: every named value expected, next to the one found."""
    left = expected.select("name", F.col("value").alias("expected"))
    right = actual.select("name", F.col("value").alias("actual"))
    return left.join(right, "name", "left").withColumn(
        "pass", F.col("expected").eqNullSafe(F.col("actual"))
    )


def require_all(results: DataFrame) -> None:
    """Fail after all assertions were evaluated, naming each one that did not hold."""
    failed = results.filter(~F.col("pass")).collect()
    if failed:
        lines = [f"{r['name']}: expected {r['expected']}, got {r['actual']}" for r in failed]
        raise AssertionError("\n".join(lines))
