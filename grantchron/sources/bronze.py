"""The append-only bronze log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from grantchron.functions.times import capture_time
from grantchron.model import BRONZE_SCHEMA, as_nullable


REJECTED = "rejected"


def with_capture_day(bronze: DataFrame, capture_ns: str = "__source_ts_ns") -> DataFrame:
    return bronze.withColumn("capture_day", capture_time(capture_ns).cast("date"))


def append_bronze(df: DataFrame, path: str, mode: str = "append") -> None:
    """Every event becomes a new row, in a folder per capture day.

    Rows of a day are brought together before the write, and days of unequal size are
    split or merged by the adaptive planner, so the number of files follows the data.
    """
    dated = with_capture_day(df).hint("rebalance", F.col("capture_day"))
    dated.write.mode(mode).partitionBy("capture_day").parquet(path)


def bronze_file_schema(schema: T.StructType = BRONZE_SCHEMA) -> T.StructType:
    return T.StructType(as_nullable(schema).fields + [T.StructField("capture_day", T.DateType())])


def read_bronze(
    spark: SparkSession, path: str, schema: T.StructType = BRONZE_SCHEMA
) -> DataFrame:
    """The log with its capture_day, which after_cursor prunes by."""
    return spark.read.schema(bronze_file_schema(schema)).parquet(path)


def only_tables(df: DataFrame, tables) -> DataFrame:
    """S3: the capture's include list. Events that name no table stay, for quarantine."""
    return df.filter(F.col("__table").isNull() | F.col("__table").isin(*tables))


def bronze_name(prefix: str, schema: str, table: str) -> str:
    """S3: the bronze table a captured table goes to."""
    return "bronze_" + f"{prefix}.{schema}.{table}".replace(".", "_")


def append_by_table(df: DataFrame, root: str, names: dict[str, str], load: int) -> None:
    """S3: one filtered write for each listed table; names maps __table to a folder.

    Events of unlisted tables, or that name none, go to the folder REJECTED. A load that is
    repeated replaces what it wrote before, and nothing else.
    """
    table = F.col("__table")
    routes = [(table == name, folder) for name, folder in names.items()]
    routes.append((table.isNull() | ~table.isin(*names), REJECTED))
    load_rows = df.persist()  # read once for all folders; lost parts are computed again
    try:
        for condition, folder in routes:
            append_bronze(load_rows.filter(condition), f"{root}/{folder}/load={load}", "overwrite")
    finally:
        load_rows.unpersist()


def snapshot_events(table: DataFrame, capture_ns: int, table_name: str, db: str) -> DataFrame:
    """Existing rows as events that precede the live changes.

    The snapshot holds a key once, so its number among equal capture times is no matter;
    it is below every number the live changes get.
    """
    return table.select(
        "*",
        F.lit("r").alias("__op"),
        F.lit(capture_ns).cast("long").alias("__source_ts_ns"),
        F.lit(table_name).alias("__table"),
        F.lit(db).alias("__db"),
        F.lit("false").alias("__deleted"),
        F.lit(-1).cast("long").alias("event_id"),
    )
