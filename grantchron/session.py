"""Session settings the library depends on, and tables written to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

HOT_KEY_ROWS = "spark.grantchron.hotKeyRows"
SMALL_INPUT_BYTES = "spark.grantchron.smallInputBytes"


def use_utc(spark: SparkSession) -> SparkSession:
    """Capture times are epoch numbers and business times have no zone: both need UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir, or a local one in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="grantchron-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


_made: list[str] = []  # folders of this driver that drop_scratch removes


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Remove what this driver wrote to scratch paths, once nothing reads it any more."""
    jvm, conf, dropped = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        dropped += path.getFileSystem(conf).delete(path, True)
    return dropped


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: fixed content, no lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_key_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(HOT_KEY_ROWS, "500000"))


def small_input_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get(SMALL_INPUT_BYTES, str(32 << 20)))


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; used to choose a plan, never a result."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size))
