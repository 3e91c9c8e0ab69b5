"""Change logs derived from the given tables (they hold no grants)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from grantchron.functions.times import capture_ns
from grantchron.model import (
    DIM_RESOURCE_SCHEMA,
    DIM_ROLE_SCHEMA,
    DIM_USER_SCHEMA,
    GRANTS,
    ChangeSpec,
)
from grantchron.operators.ordered import OrderedRuns
from grantchron.session import materialize, use_utc

DB, TABLE = "iam_source", "iam_denormalized"

# The columns of the derived log; names and categories are not among them.
EVENT_ROW = T.StructType(
    [
        T.StructField("grant_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("role_id", T.LongType()),
        T.StructField("resource_id", T.LongType()),
        T.StructField("granted_at", T.TimestampNTZType()),
        T.StructField("revoked_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("is_deleted", T.BooleanType()),
    ]
)
EVENT_LOG = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        *EVENT_ROW.fields,
        T.StructField("__op", T.StringType()),
        T.StructField("__source_ts_ns", T.LongType()),
        T.StructField("__table", T.StringType()),
        T.StructField("__db", T.StringType()),
        T.StructField("__deleted", T.StringType()),
    ]
)

# orders as a log: keyed by customer, numbered by order, timed by day (so with ties).
ORDERS = ChangeSpec(
    key=("o_custkey",),
    attributes=("revoked_at", "updated_at", "is_deleted"),
    updated=("revoked_at", "updated_at", "is_deleted"),
    versioned=("revoked_at",),
    sequence="o_orderkey",
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf}/{name}.parquet")


def event_log(
    spark: SparkSession, sf: str, hot_limit: int | None = None, before_ns: int | None = None
) -> DataFrame:
    """events as a bronze log: one grant per user_id. An event is told by those before it, so that
    the log up to a capture time (before_ns, itself left out) needs none of the later events.
    """
    kind, ts = F.col("event_type"), F.col("ts")
    events = table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").alias("grant_id"),
        "event_type",
        "ts",
        capture_ns(ts).alias("__source_ts_ns"),
    )
    if before_ns is not None:
        events = events.filter(F.col("__source_ts_ns") < before_ns)
    runs = OrderedRuns(events, GRANTS.key, GRANTS.order, hot_limit).add(
        prev={"__prev": F.struct("event_type")}
    )
    op = (
        F.when(kind == "error", "d")
        .when(F.col("__prev").isNull(), "r")
        .when(F.col("__prev.event_type") == "error", "c")
        .otherwise("u")
    )

    def alive(value):
        return F.when(kind != "error", value)

    log = runs.rows().select(
        "event_id",
        "grant_id",
        alive(F.col("grant_id")).alias("user_id"),
        alive(1 + F.col("event_id") % 3).alias("role_id"),
        alive(501 + F.col("event_id") % 7).alias("resource_id"),
        alive(ts).alias("granted_at"),
        F.when(kind == "purchase", ts).alias("revoked_at"),
        alive(ts).alias("updated_at"),
        alive((kind == "signup") & (F.col("event_id") % 11 == 0)).alias("is_deleted"),
        op.alias("__op"),
        "__source_ts_ns",
        F.lit(TABLE).alias("__table"),
        F.lit(DB).alias("__db"),
        F.when(kind == "error", "true").otherwise("false").alias("__deleted"),
    )
    # Bronze is a stored table. Where deriving it took more than a window, it is one here.
    return materialize(log, "event-log") if runs.split else log


#: What named_log adds to the log: names of users, roles and resources.
NAMED_LOG = T.StructType(
    EVENT_LOG.fields
    + [f for schema in (DIM_USER_SCHEMA, DIM_ROLE_SCHEMA, DIM_RESOURCE_SCHEMA) for f in schema.fields[1:]]
)


def named_log(spark: SparkSession, sf: str, before_ns: int | None = None) -> DataFrame:
    """The log with names; a user's address changes now and then, a role's category once."""
    said, number = "CAST({} AS string)", F.col("event_id")
    user, role, resource = (F.expr(said.format(c)) for c in ("user_id", "role_id", "resource_id"))
    moved = F.floor(number / 50) % 3
    return event_log(spark, sf, before_ns=before_ns).withColumns(
        {
            "user_name": F.concat(F.lit("user "), user),
            "user_email": F.concat(F.lit("u"), user, F.lit("@d"), moved.cast("string"), F.lit(".example")),
            "role_name": F.concat(F.lit("role "), role),
            "role_category": F.when(role.isNotNull(), F.when(number < 500, "early").otherwise("late")),
            "resource_name": F.concat(F.lit("resource "), resource),
            "resource_type": F.when(F.col("resource_id") % 2 == 0, "database"),
        }
    ).select(*NAMED_LOG.names)


def order_log(spark: SparkSession, sf: str, hot_limit: int | None = None) -> DataFrame:
    """orders as a log whose arrival order is not its time order."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        "o_orderpriority",
        "o_orderstatus",
        capture_ns(F.col("o_orderdate")).alias("__source_ts_ns"),
    )
    runs = OrderedRuns(orders, ORDERS.key, ORDERS.order, hot_limit).add(
        prev={"__prev": F.struct("o_orderkey")}
    )
    op = (
        F.when(F.col("__prev").isNull(), "r")
        .when(F.col("o_orderpriority") == "1-URGENT", "d")
        .otherwise("u")
    )
    log = runs.rows().select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("revoked_at"),
        F.col("o_orderdate").alias("updated_at"),
        F.lit(False).alias("is_deleted"),
        op.alias("__op"),
        "__source_ts_ns",
    )
    return materialize(log, "order-log") if runs.split else log
