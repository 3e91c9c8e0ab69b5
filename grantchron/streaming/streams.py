"""Capture to bronze and bronze to gold as Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from grantchron.model import BRONZE_SCHEMA
from grantchron.plans.merge import run_merge
from grantchron.plans.store import GoldStore
from grantchron.sources.bronze import (
    append_by_table,
    bronze_file_schema,
    only_tables,
    with_capture_day,
)
from grantchron.sources.cdc import flatten_cdc

# What arrives from the capture: one JSON envelope per row, with its arrival number.
MESSAGE_SCHEMA = T.StructType(
    [T.StructField("event_id", T.LongType()), T.StructField("value", T.StringType())]
)


# Take what has arrived and end. Continuous capture passes e.g. {"processingTime": "1 second"}.
AVAILABLE_NOW = {"availableNow": True}


def read_messages(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def stream_to_bronze(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    row_schema: T.StructType,
    tables,
    trigger: dict | None = None,
) -> StreamingQuery:
    """S1 + S2 + S3 + S9: flatten, keep the listed tables, append; resumes from the checkpoint.

    Messages that name no table, such as those that do not parse, are kept too: the merge
    puts them in quarantine.
    """
    flat = only_tables(flatten_cdc(messages, row_schema, sequence="event_id"), tables)
    return (
        with_capture_day(flat)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy("capture_day")
        .trigger(**(trigger or AVAILABLE_NOW))
        .start(path)
    )


def stream_by_table(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    row_schema: T.StructType,
    names: dict[str, str],
    trigger: dict | None = None,
) -> StreamingQuery:
    """S3 with a bronze folder per captured table, read as <root>/<name>/load=*.

    Each micro-batch owns a load folder and replaces it when run again after a failure.
    Events of other tables or of none go to <root>/rejected.
    """
    flat = flatten_cdc(messages, row_schema, sequence="event_id")
    return (
        flat.writeStream.foreachBatch(lambda df, load: append_by_table(df, root, names, load))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def stream_to_gold(
    store: GoldStore,
    bronze_path: str,
    checkpoint: str,
    bronze_schema: T.StructType = BRONZE_SCHEMA,
    files_per_trigger: int | None = None,
    mode: str = "all",
    after_batch: Callable[[GoldStore, int], None] | None = None,
    trigger: dict | None = None,
    **merge_options,
) -> StreamingQuery:
    """One merge per micro-batch of bronze files.

    The checkpoint remembers which files were read, so late and tied events are merged
    too; the store remembers the micro-batch by the stream's id, so one that is run again
    changes nothing. A stream with a new checkpoint, or one that follows a seed by
    run_merge, has another id: it merges what it reads but for events that gold has.
    """
    reader = store.spark.readStream.schema(bronze_file_schema(bronze_schema))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def merge(batch: DataFrame, batch_id: int) -> None:
        here = store.with_session(batch.sparkSession)
        stream = _stream_id(here.spark, checkpoint)
        run_merge(here, batch, mode=mode, stream=stream, batch_id=batch_id, **merge_options)
        if after_batch:
            after_batch(here, batch_id)

    return (
        reader.parquet(bronze_path)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream and keeps in its checkpoint."""
    [row] = spark.read.schema("id string").json(f"{checkpoint}/metadata").collect()
    return row["id"]


def finish(query: StreamingQuery, timeout: int = 600) -> None:
    """Wait for an availableNow query; fail if it does not end in time."""
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {query.id} still running after {timeout} s")
