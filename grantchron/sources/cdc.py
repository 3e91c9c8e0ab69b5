"""Change envelopes as JSON text to flat bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from grantchron.functions.times import epoch_micros, since_epoch
from grantchron.model import as_nullable

_UNITS = {"micros": "MICROSECOND", "millis": "MILLISECOND"}


def envelope_schema(row_schema: T.StructType, time_unit: str = "micros") -> T.StructType:
    """The envelope; its zone-free timestamps are epoch numbers, or ISO text."""
    wire = T.StringType() if time_unit == "iso" else T.LongType()
    row = T.StructType(
        [
            T.StructField(f.name, wire if isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
            for f in as_nullable(row_schema).fields
        ]
    )
    source = T.StructType(
        [
            T.StructField("ts_ns", T.LongType()),
            T.StructField("table", T.StringType()),
            T.StructField("db", T.StringType()),
        ]
    )
    return T.StructType(
        [
            T.StructField("before", row),
            T.StructField("after", row),
            T.StructField("op", T.StringType()),
            T.StructField("source", source),
        ]
    )


def _time(name: str, time_unit: str) -> Column:
    if time_unit == "iso":
        return F.col(f"r.{name}").cast("timestamp_ntz")
    return since_epoch(f"r.`{name}`", _UNITS[time_unit])


def flatten_cdc(
    df: DataFrame,
    row_schema: T.StructType,
    value: str = "value",
    sequence: str | None = None,
    time_unit: str = "micros",
    with_schema: bool = True,
) -> DataFrame:
    """The new row state with __op, __table, __source_ts_ns, __db, __deleted.

    A delete keeps its before image, marked __deleted; tombstones (no value) are dropped.
    with_schema says that each message wraps the envelope as {schema, payload}. A value
    that does not parse gives a row without op, which the merge quarantines.
    """
    envelope = envelope_schema(row_schema, time_unit)
    message = T.StructType([T.StructField("payload", envelope)]) if with_schema else envelope
    keep = [sequence] if sequence else []
    parsed = df.filter(F.col(value).isNotNull()).select(
        *keep, F.from_json(F.col(value), message).alias("m")
    )
    p = F.col("m.payload") if with_schema else F.col("m")
    row = F.coalesce(p["after"], p["before"])
    flat = parsed.select(*keep, row.alias("r"), p.alias("p"))
    return flat.select(
        *[
            _time(f.name, time_unit).alias(f.name)
            if isinstance(f.dataType, T.TimestampNTZType)
            else F.col(f"r.{f.name}").alias(f.name)
            for f in row_schema.fields
        ],
        F.col("p.op").alias("__op"),
        F.col("p.source.ts_ns").alias("__source_ts_ns"),
        F.col("p.source.table").alias("__table"),
        F.col("p.source.db").alias("__db"),
        F.when(F.col("p.op") == "d", F.lit("true")).otherwise(F.lit("false")).alias("__deleted"),
        *[F.col(k).alias("event_id") for k in keep],
    )


def to_envelope(
    bronze: DataFrame, row_schema: T.StructType, key=("grant_id",), with_schema: bool = True
) -> DataFrame:
    """Bronze rows back to envelopes (event_id, value): fixtures for S2 and for the streams."""
    def image(columns) -> Column:
        return F.struct(
            *[
                epoch_micros(F.col(f.name)).alias(f.name)
                if isinstance(f.dataType, T.TimestampNTZType)
                else F.col(f.name)
                for f in row_schema.fields
                if f.name in columns
            ]
        )

    op = F.col("__op")
    envelope = F.struct(
        F.when(op == "d", image(key)).alias("before"),
        F.when(op != "d", image(row_schema.names)).alias("after"),
        op.alias("op"),
        F.struct(
            F.col("__source_ts_ns").alias("ts_ns"),
            F.col("__table").alias("table"),
            F.col("__db").alias("db"),
        ).alias("source"),
    )
    message = F.struct(envelope.alias("payload")) if with_schema else envelope
    return bronze.select("event_id", F.to_json(message).alias("value"))
