"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]: one warm-up, then the median of three.

Prints one JSON line: seconds per query, their sum, and events per second of the stream.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from grantchron.operators import temporal
from grantchron.plans.merge import run_merge
from grantchron.plans.queries import INSTANT, QUERIES
from grantchron.plans.store import GoldStore
from grantchron.plans.testdata import EVENT_LOG, event_log, table
from grantchron.session import scratch_path
from grantchron.sources import bronze
from grantchron.streaming import streams

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
RUNS = 3

REGISTERED = (
    "cdc_batch_latest", "scd1_all_events", "scd2_all_events", "scd2_latest_two_batches",
    "asof_subject", "asof_batched", "asof_resource_daily", "removal_kind", "snapshot_diff",
    "dim_user_latest", "flatten_envelope",
)


def session() -> SparkSession:
    base = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("grantchron-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{base}/shared")
        .config("spark.sql.warehouse.dir", f"{base}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def merges(spark: SparkSession, log: str, grown: str) -> dict[str, float]:
    """First merge into empty gold, a second with 1 % more events, and one without news."""
    store = GoldStore(spark, scratch_path(spark, "gold"))
    times = {}
    for name, path in (("merge_first", log), ("merge_second", grown), ("merge_noop", grown)):
        started = time.perf_counter()
        run_merge(store, bronze.read_bronze(spark, path, EVENT_LOG))
        times[name] = time.perf_counter() - started
    started = time.perf_counter()
    run(temporal.as_of(store.history(), INSTANT))
    times["asof_stored"] = time.perf_counter() - started
    started = time.perf_counter()
    probes = table(spark, SF_DIR, "orders").select(
        F.col("o_custkey").alias("grant_id"),
        F.timestamp_seconds(1_704_067_200 + F.col("o_orderkey") * 7919 % 2_592_000)
        .cast("timestamp_ntz")
        .alias("t"),
    )
    run(temporal.as_of_probes(store.history(), probes, ["grant_id"], "t"))
    times["asof_batched_stored"] = time.perf_counter() - started
    return times


def stream(spark: SparkSession, log: str) -> dict[str, float]:
    store = GoldStore(spark, scratch_path(spark, "gold"))
    started = time.perf_counter()
    streams.finish(
        streams.stream_to_gold(
            store, log, scratch_path(spark, "checkpoint"), bronze_schema=EVENT_LOG
        )
    )
    return {"stream_replay": time.perf_counter() - started}


def timed(spark: SparkSession, name: str) -> dict[str, float]:
    started = time.perf_counter()
    run(QUERIES[name](spark, SF_DIR))
    return {name: time.perf_counter() - started}


def main() -> None:
    spark = session()
    events = event_log(spark, SF_DIR)
    cut = events.agg(F.percentile_approx("__source_ts_ns", 0.99, 10_000)).first()[0]
    log, grown = scratch_path(spark, "bronze"), scratch_path(spark, "bronze")
    bronze.append_bronze(events.filter(F.col("__source_ts_ns") <= cut), log)
    bronze.append_bronze(events, grown)

    jobs = [lambda n=n: timed(spark, n) for n in REGISTERED]
    jobs += [lambda: merges(spark, log, grown), lambda: stream(spark, grown)]
    medians: dict[str, float] = {}
    for job in jobs:
        samples: dict[str, list[float]] = {}
        for i in range(RUNS + 1):
            for name, seconds in job().items():
                if i:
                    samples.setdefault(name, []).append(seconds)
        medians |= {n: round(statistics.median(s), 3) for n, s in samples.items()}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "stream_events_per_sec": round(events.count() / medians["stream_replay"]),
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
