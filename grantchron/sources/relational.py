"""The source table over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    fetch_rows: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """A read split by ranges of `column`: one query per partition, streamed in fetches."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_rows),
        **properties,
    }


def read_source(spark: SparkSession, **options) -> DataFrame:
    """S7. Takes jdbc_options' arguments; filters and columns are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()
