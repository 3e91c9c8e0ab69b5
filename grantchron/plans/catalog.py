"""The star schema as catalog tables and views (M1-M3, M6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from grantchron import model
from grantchron.plans.store import GoldStore

# Day columns take the place of a day() partition transform, which Parquet tables lack.
TABLES: dict[str, tuple[T.StructType, str | None]] = {
    "dim_user": (model.DIM_USER_SCHEMA, None),
    "dim_role": (model.DIM_ROLE_SCHEMA, None),
    "dim_resource": (model.DIM_RESOURCE_SCHEMA, None),
    model.FACT_TABLE: (model.FACT_SCHEMA, "updated_day"),
    model.HISTORY_TABLE: (model.HISTORY_SCHEMA, "start_day"),
    model.WATERMARK_TABLE: (model.WATERMARK_SCHEMA, None),
}
HISTORY_BY_DAY = model.HISTORY_TABLE + "_by_day"
ACTIVE = "revoked_at IS NULL AND is_deleted = false"
EXPECTED = (*TABLES, model.ACTIVE_VIEW)


def publish_tables(store: GoldStore, database: str = "iam") -> None:
    """M1-M4, A1-A6, E3 by name, for any session of the catalog: what the store's newest version holds.

    Views over the store's files, to be published again after a merge. A table of the same
    name that create_star_schema made, and nothing filled, gives way.
    """
    spark, commit = store.spark, store.latest()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def view(name: str, query: str) -> None:
        if spark.catalog.tableExists(f"{database}.{name}"):
            if spark.catalog.getTable(f"{database}.{name}").tableType != "VIEW":
                if not spark.table(f"{database}.{name}").isEmpty():
                    raise ValueError(f"{database}.{name} is a table with rows")
                spark.sql(f"DROP TABLE {database}.{name}")
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {query}")

    def none(schema: T.StructType) -> str:
        columns = (f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields)
        return f"SELECT {', '.join(columns)} WHERE false"

    def stored(table: str, columns: list[str], where: str) -> str:
        return f"SELECT {', '.join(columns)} FROM parquet.`{store.path}/{table}` WHERE {where}"

    def live(slots: dict[str, str]) -> str:
        held = ", ".join(f"'{batch}/{slot}'" for slot, batch in sorted(slots.items()))
        return f"concat_ws('/', batch, CAST(slot AS string)) IN ({held})"

    fact, history = store.fact_schema, store.history_schema
    view(
        model.FACT_TABLE,
        stored("current", fact.names, live(commit.current)) if commit.current else none(fact),
    )
    if commit.open:
        view(HISTORY_BY_DAY, _periods_by_day(store, stored, live))
    else:
        kinds = [*history.fields, T.StructField("end_day", T.DateType()), T.StructField("ending", T.StringType())]
        view(HISTORY_BY_DAY, none(T.StructType(kinds)))
    view(model.HISTORY_TABLE, f"SELECT {', '.join(history.names)} FROM {database}.{HISTORY_BY_DAY}")
    _publish_questions(spark, database, store.history_schema)
    view(
        model.ACTIVE_VIEW,
        f"SELECT * FROM {database}.{model.FACT_TABLE} WHERE {ACTIVE}",
    )
    for dim in store.dimensions:
        state = commit.dims.get(dim.name)
        if state is None:
            view(dim.name, none(dim.stored))
            continue
        taken = ", ".join(f"'{b}'" for b in state["closed"])
        where = (
            f"(is_current = 'true' AND {live(state['open'])}) "
            f"OR (is_current = 'false' AND batch IN ({taken}))"
        )
        columns = ["effective_end IS NULL AS is_current" if c == "is_current" else c for c in dim.stored.names]
        view(dim.name, stored(f"dims/{dim.name}", columns, where))
    cursor = commit.cursor
    view(
        model.WATERMARK_TABLE,
        f"SELECT '{model.HISTORY_TABLE}' AS target_table, CAST({cursor[0]} AS bigint) AS last_processed_ts"
        if cursor
        else none(model.WATERMARK_SCHEMA),
    )


def _periods_by_day(store: GoldStore, stored, live) -> str:
    """The history with end_day, the folder of closed periods, and with how each period ended."""
    commit, names = store.latest(), store.history_schema.names
    taken = ", ".join(f"'{b}'" for b in commit.closed)
    is_open = "effective_end IS NULL"
    open_columns = [f"{is_open} AS {c}" if c == "is_current" else c for c in names]
    open_columns += ["CAST(effective_end AS date) AS end_day", f"if({is_open}, 'open', ending) AS ending"]
    closed_columns = ["false AS is_current" if c == "is_current" else c for c in names]
    closed_columns += ["try_cast(slot AS date) AS end_day", "ending"]
    return (
        stored("history", closed_columns, f"is_current = 'false' AND batch IN ({taken})")
        + " UNION ALL "
        + stored("history", open_columns, f"is_current = 'true' AND {live(commit.open)}")
    )


#: The audit questions as table functions: name, parameters, condition on the history.
QUESTIONS = (
    (  # A1-A4: add conditions on who and what
        "access_as_of",
        "t TIMESTAMP_NTZ",
        "(end_day IS NULL OR end_day >= CAST(access_as_of.t AS DATE)) AND effective_start <= access_as_of.t "
        "AND (effective_end IS NULL OR effective_end > access_as_of.t)",
    ),
    (  # A5
        "ended_at",
        "t TIMESTAMP_NTZ",
        "end_day = CAST(ended_at.t AS DATE) AND effective_end = ended_at.t",
    ),
    (
        "ended_between",
        "since TIMESTAMP_NTZ, until TIMESTAMP_NTZ",
        "end_day BETWEEN CAST(ended_between.since AS DATE) AND CAST(ended_between.until AS DATE) "
        "AND effective_end >= ended_between.since AND effective_end < ended_between.until",
    ),
)


def _publish_questions(spark: SparkSession, database: str, schema: T.StructType) -> None:
    """A1-A6 for SQL users: their bodies name the days to read, so that no other is opened.

    Spark finds table functions in the session's current schema: USE the database first.
    """
    fields = [*schema.fields, T.StructField("ending", T.StringType())]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    names = ", ".join(f.name for f in fields)
    for name, parameters, condition in QUESTIONS:
        spark.sql(
            f"CREATE OR REPLACE FUNCTION {database}.{name}({parameters}) RETURNS TABLE ({columns}) "
            f"RETURN SELECT {names} FROM {database}.{HISTORY_BY_DAY} WHERE {condition}"
        )


def create_star_schema(spark: SparkSession, database: str = "iam") -> None:
    """M1 + M3: database, dimensions, facts and the active view, where they do not exist."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (schema, day) in TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        if day:
            columns += f", {day} date"
        partitioned = f" PARTITIONED BY ({day})" if day else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING PARQUET{partitioned}"
        )
    spark.sql(
        f"CREATE OR REPLACE VIEW {database}.{model.ACTIVE_VIEW} AS "
        f"SELECT {', '.join(model.FACT_SCHEMA.names)} FROM {database}.{model.FACT_TABLE} "
        f"WHERE {ACTIVE}"
    )


def append_by_day(df: DataFrame, table: str, time: str, day: str) -> None:
    """M2: append to a table partitioned by the day of a timestamp."""
    columns = df.sparkSession.table(table).columns
    dated = df.withColumn(day, F.col(time).cast("date"))
    dated.hint("rebalance", F.col(day)).select(*columns).write.insertInto(table)


def publish_views(store: GoldStore, prefix: str = "") -> None:
    """The store's newest version as temporary views under the names auditors query."""
    commit = store.latest()
    current = store.current(commit)
    current.createOrReplaceTempView(prefix + model.FACT_TABLE)
    store.history(commit).createOrReplaceTempView(prefix + model.HISTORY_TABLE)
    store.watermark().createOrReplaceTempView(prefix + model.WATERMARK_TABLE)
    current.filter("revoked_at IS NULL AND is_deleted = false").createOrReplaceTempView(
        prefix + model.ACTIVE_VIEW
    )


def drop_star_schema(spark: SparkSession, database: str = "iam") -> None:
    """M6: drop it with all it holds; checks.missing_tables then lists every table."""
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
