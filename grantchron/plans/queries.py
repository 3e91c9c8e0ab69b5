"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from grantchron.functions.times import covers, ntz
from grantchron.model import ACTIVE_VIEW, FACT_TABLE, GRANT_DIMENSIONS, GRANTS, HISTORY_TABLE, WATERMARK_TABLE
from grantchron.operators import batch, checks, dims, scd, temporal
from grantchron.operators.ordered import OrderedRuns
from grantchron.plans import audit, catalog, dimensions
from grantchron.plans.merge import run_merge
from grantchron.plans.store import GoldStore
from grantchron.plans.testdata import DB, EVENT_LOG, EVENT_ROW, NAMED_LOG, ORDERS, TABLE
from grantchron.plans.testdata import event_log, named_log, order_log, table
from grantchron.session import materialize, scratch_path
from grantchron.sources import bronze, cdc, snapshots
from grantchron.streaming import streams

SPLIT = "2024-01-16 00:00:00"
INSTANT = "2024-01-15 00:00:00"
SPLIT_NS = 1_705_363_200_000_000_000  # SPLIT as a capture time

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _count(condition=None):
    return F.count(F.lit(1)) if condition is None else F.count_if(condition)


def _history(spark: SparkSession, sf: str) -> DataFrame:
    return scd.access_history(event_log(spark, sf))


def _state(spark: SparkSession, sf: str) -> DataFrame:
    return scd.current_state(event_log(spark, sf))


def _halves(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two merge batches: the log before and from SPLIT."""
    ns = F.col("__source_ts_ns")
    return log.filter(ns < SPLIT_NS), log.filter(ns >= SPLIT_NS)


def _related_halves(log: DataFrame, mode: str) -> list[DataFrame]:
    return [batch.relate_events(batch.stage(half), mode=mode) for half in _halves(log)]


def _two_merges(log: DataFrame, mode: str) -> DataFrame:
    first, second = _related_halves(log, mode)
    after_first = scd.scd2_merge(None, first)
    after_second = scd.scd2_merge(after_first.filter("is_current"), second)
    return after_first.filter("NOT is_current").unionByName(after_second)


# -- incremental batch -----------------------------------------------------------------


@query
def cdc_op_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Events per operation and whether they close access."""
    return (
        batch.stage(event_log(spark, sf)).groupBy("op", "closes_access").agg(_count().alias("events"))
    )


@query
def cdc_batch_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The batch of a first run."""
    log = batch.after_cursor(event_log(spark, sf), None)
    return batch.latest_per_key(batch.stage(log))


@query
def cdc_second_batch(spark: SparkSession, sf: str) -> DataFrame:
    """C1 with the cursor that the first batch left (T4)."""
    log = event_log(spark, sf)
    cursor = batch.cursor_after(_halves(log)[0], None).first()
    return batch.latest_per_key(batch.stage(batch.after_cursor(log, tuple(cursor))))


@query
def cursor_advance(spark: SparkSession, sf: str) -> DataFrame:
    """T4 after each of two batches."""
    first, second = _halves(event_log(spark, sf))
    reached = batch.cursor_after(first, None).first()
    rows = [
        df.select(F.lit(run).alias("run"), F.col("__source_ts_ns").alias("last_processed_ts"))
        for run, df in enumerate(
            [batch.cursor_after(first, None), batch.cursor_after(second, tuple(reached))], 1
        )
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def cursor_empty_batch_keeps(spark: SparkSession, sf: str) -> DataFrame:
    """T4 on three runs without new events."""
    log = event_log(spark, sf)
    cursor = tuple(batch.cursor_after(log, None).first())
    rows = []
    for run in (1, 2, 3):
        fresh = batch.after_cursor(log, cursor)
        kept = batch.cursor_after(fresh, cursor)
        rows.append(
            kept.select(
                F.lit(run).alias("run"),
                F.lit(fresh.count()).cast("long").alias("new_events"),
                F.col("__source_ts_ns").alias("last_processed_ts"),
            )
        )
        cursor = tuple(kept.first())
    return reduce(DataFrame.unionByName, rows)


# -- gold merges -----------------------------------------------------------------------


@query
def scd1_one_batch(spark: SparkSession, sf: str) -> DataFrame:
    """T1 into an empty table, latest event per key."""
    return scd.current_state(event_log(spark, sf), mode="latest")


@query
def scd1_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    """T1 twice; user_id and granted_at keep what the first run inserted."""
    first, second = _related_halves(event_log(spark, sf), "latest")
    return scd.scd1_merge(scd.scd1_merge(None, first), second)


@query
def scd1_all_events(spark: SparkSession, sf: str) -> DataFrame:
    """T1 with every event taken in order."""
    return _state(spark, sf)


@query
def scd1_all_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    """T1 with every event, in two runs: the same rows as in one."""
    first, second = _related_halves(event_log(spark, sf), "all")
    return scd.scd1_merge(scd.scd1_merge(None, first), second)


@query
def scd2_latest_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    """C2, T2, T3 as the original statements run them, twice."""
    return _two_merges(event_log(spark, sf), "latest")


@query
def scd2_all_events(spark: SparkSession, sf: str) -> DataFrame:
    """E1 in one pass."""
    return _history(spark, sf)


@query
def scd2_all_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    """E1 in two runs: the same rows as in one."""
    return _two_merges(event_log(spark, sf), "all")


@query
def scd2_prerevoked_closed(spark: SparkSession, sf: str) -> DataFrame:
    """E1 where a row that arrives revoked opens nothing."""
    return scd.access_history(event_log(spark, sf), prerevoked="closed")


def _revoked_later(spark: SparkSession, sf: str) -> DataFrame:
    """The log with each revocation a day later, which may be after the next event."""
    later = F.col("revoked_at") + F.expr("INTERVAL 1 DAY")
    return event_log(spark, sf).withColumn("revoked_at", later)


@query
def scd2_prerevoked_later(spark: SparkSession, sf: str) -> DataFrame:
    """E1, D4 where rows arrive with a revocation to come: the earlier of it and the next event."""
    return scd.access_history(_revoked_later(spark, sf), prerevoked="closed")


@query
def prerevoked_two_merges(spark: SparkSession, sf: str) -> DataFrame:
    """The same in two stored runs; the second ends periods that were to end later."""
    store = GoldStore(spark, scratch_path(spark, "gold"))
    path = scratch_path(spark, "bronze")
    for part in _halves(_revoked_later(spark, sf)):
        bronze.append_bronze(part, path)
        run_merge(store, bronze.read_bronze(spark, path, EVENT_LOG), prerevoked="closed")
    return store.history().drop("end_day")


@query
def merge_runs_in_store(spark: SparkSession, sf: str) -> DataFrame:
    """A stored log merged in two runs, read back as history."""
    first, second = _halves(event_log(spark, sf))
    path = scratch_path(spark, "bronze")
    store = GoldStore(spark, scratch_path(spark, "gold"))
    for part in (first, second):
        bronze.append_bronze(part, path)
        run_merge(store, bronze.read_bronze(spark, path, EVENT_LOG))
    return store.history().drop("end_day")


@query
def stream_merge_equals_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The log arrives in three parts, each merged by a resumed stream."""
    log = materialize(event_log(spark, sf), "event-log")
    low, high = log.agg(F.percentile_approx("__source_ts_ns", [1 / 3, 2 / 3], 1000)).first()[0]
    ns = F.col("__source_ts_ns")
    path, checkpoint = scratch_path(spark, "bronze"), scratch_path(spark, "checkpoint")
    store = GoldStore(spark, scratch_path(spark, "gold"))
    for part in (ns <= low, (ns > low) & (ns <= high), ns > high):
        bronze.append_bronze(log.filter(part), path)
        streams.finish(
            streams.stream_to_gold(store, path, checkpoint, bronze_schema=EVENT_LOG)
        )
    return store.history().drop("end_day")


@query
def seed_then_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A first merge of half the log, then a stream over all of it."""
    first, second = _halves(event_log(spark, sf))
    path, store = scratch_path(spark, "bronze"), GoldStore(spark, scratch_path(spark, "gold"))
    bronze.append_bronze(first, path)
    run_merge(store, bronze.read_bronze(spark, path, EVENT_LOG))
    bronze.append_bronze(second, path)
    streams.finish(
        streams.stream_to_gold(
            store, path, scratch_path(spark, "checkpoint"), bronze_schema=EVENT_LOG
        )
    )
    return store.history().drop("end_day")


@query
def stream_new_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """Half the log by a stream, then all of it by one with another checkpoint."""
    path, store = scratch_path(spark, "bronze"), GoldStore(spark, scratch_path(spark, "gold"))
    for part in _halves(event_log(spark, sf)):
        bronze.append_bronze(part, path)
        checkpoint = scratch_path(spark, "checkpoint")
        streams.finish(streams.stream_to_gold(store, path, checkpoint, bronze_schema=EVENT_LOG))
    return store.history().drop("end_day")


@query
def cursor_table(spark: SparkSession, sf: str) -> DataFrame:
    """M4: the stored cursor after a merge."""
    return _stored(spark, sf).watermark()


def _by_name(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A merge published to the catalog, and the table asked for in SQL by another session."""
    database = f"iam_{uuid.uuid4().hex}"
    catalog.publish_tables(_stored(spark, sf), database)
    return spark.newSession().sql(f"SELECT * FROM {database}.{name}")


@query
def named_history(spark: SparkSession, sf: str) -> DataFrame:
    """M1, M2 by name."""
    return _by_name(spark, sf, HISTORY_TABLE)


@query
def named_state(spark: SparkSession, sf: str) -> DataFrame:
    """M1 by name."""
    return _by_name(spark, sf, FACT_TABLE)


@query
def named_active(spark: SparkSession, sf: str) -> DataFrame:
    """M3 by name."""
    return _by_name(spark, sf, ACTIVE_VIEW)


@query
def named_cursor(spark: SparkSession, sf: str) -> DataFrame:
    """M4 by name."""
    return _by_name(spark, sf, WATERMARK_TABLE)


def _asked(spark: SparkSession, sf: str, question: str) -> DataFrame:
    """A question to a table function of a published merge, by another session."""
    database = f"iam_{uuid.uuid4().hex}"
    catalog.publish_tables(_stored(spark, sf), database)
    other = spark.newSession()
    other.sql(f"USE {database}")  # Spark looks for table functions in the current schema only
    return other.sql(f"SELECT * FROM {question}").drop("ending")


@query
def sql_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """A1-A4 in SQL."""
    return _asked(spark, sf, f"access_as_of(TIMESTAMP_NTZ'{INSTANT}')")


@query
def sql_ended_between(spark: SparkSession, sf: str) -> DataFrame:
    """A5 in SQL, over a day."""
    return _asked(spark, sf, f"ended_between(TIMESTAMP_NTZ'{INSTANT}', TIMESTAMP_NTZ'{SPLIT}')")


@query
def schema_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """M1, M6, V5: what of the schema is there once created and published, and after a reset."""
    database = f"iam_{uuid.uuid4().hex}"

    def inventory(step: str) -> list[tuple]:
        missing = set(checks.missing_tables(spark, database, catalog.EXPECTED))
        return [(step, name, name not in missing) for name in catalog.EXPECTED]

    catalog.create_star_schema(spark, database)
    catalog.publish_tables(_stored(spark, sf), database)
    found = inventory("made")
    catalog.drop_star_schema(spark, database)
    spark.sql(f"CREATE DATABASE {database}")
    found += inventory("reset")
    return spark.createDataFrame(found, "step string, table_name string, present boolean")


def _stored(spark: SparkSession, sf: str) -> GoldStore:
    path, store = scratch_path(spark, "bronze"), GoldStore(spark, scratch_path(spark, "gold"))
    bronze.append_bronze(event_log(spark, sf), path)
    run_merge(store, bronze.read_bronze(spark, path, EVENT_LOG))
    return store


# -- temporal and audit queries --------------------------------------------------------


@query
def active_access(spark: SparkSession, sf: str) -> DataFrame:
    """M3, A8."""
    return temporal.in_key_order(temporal.active_access(_state(spark, sf)))


@query
def current_state(spark: SparkSession, sf: str) -> DataFrame:
    """A7."""
    return temporal.in_key_order(_state(spark, sf))


@query
def asof_subject(spark: SparkSession, sf: str) -> DataFrame:
    """A1 for every user: the periods live at one instant."""
    return temporal.as_of(_history(spark, sf), INSTANT)


@query
def asof_resource(spark: SparkSession, sf: str) -> DataFrame:
    """A2 for every resource: who could reach it at one instant."""
    return temporal.as_of(_history(spark, sf), INSTANT).select(
        "resource_id", "user_id", "role_id", "effective_start"
    )


@query
def asof_exists(spark: SparkSession, sf: str) -> DataFrame:
    """A3 for every user."""
    return _history(spark, sf).groupBy("user_id").agg(F.bool_or(covers(INSTANT)).alias("existed"))


@query
def asof_pair(spark: SparkSession, sf: str) -> DataFrame:
    """A4 for every user and resource that ever met: live at the instant or not."""
    return (
        _history(spark, sf)
        .groupBy("user_id", "resource_id")
        .agg(_count(covers(INSTANT)).alias("live_periods"), _count().alias("periods"))
    )


def _one(history: DataFrame, *columns: str) -> dict:
    """Values of the period that starts last, of those the lowest key's."""
    last = history.orderBy(F.desc("effective_start"), "grant_id").select(*columns).first()
    return last.asDict()


@query
def asof_one_subject(spark: SparkSession, sf: str) -> DataFrame:
    """A1 on stored gold, for one subject, at the start of the last period."""
    history = _stored(spark, sf).history()
    one = _one(history, "user_id", "effective_start")
    return temporal.as_of(history, one["effective_start"], user_id=one["user_id"]).drop("end_day")


@query
def asof_one_resource(spark: SparkSession, sf: str) -> DataFrame:
    """A2 on stored gold, for one resource."""
    history = _stored(spark, sf).history()
    resource = _one(history, "resource_id")
    return temporal.as_of(history, INSTANT, **resource).drop("end_day")


@query
def existed_at(spark: SparkSession, sf: str) -> DataFrame:
    """A3 for one subject, at an instant within its last period and one before all."""
    history = materialize(_history(spark, sf), "history")
    one = _one(history, "user_id", "effective_start")
    times = (("within", one["effective_start"]), ("before", "2000-01-01 00:00:00"))
    return reduce(
        DataFrame.unionByName,
        [
            temporal.existed_at(history, t, user_id=one["user_id"]).withColumn("asked", F.lit(name))
            for name, t in times
        ],
    )


@query
def asof_user_resource(spark: SparkSession, sf: str) -> DataFrame:
    """A4 for one subject and resource."""
    history = materialize(_history(spark, sf), "history")
    one = _one(history, "user_id", "resource_id", "effective_start")
    return temporal.as_of(history, one.pop("effective_start"), **one)


@query
def event_trail_of_key(spark: SparkSession, sf: str) -> DataFrame:
    """A10 for the key with the last event."""
    log = materialize(event_log(spark, sf), "event-log")
    key = log.orderBy(F.desc("event_id")).select("grant_id").first()["grant_id"]
    trail = temporal.event_trail(log, grant_id=key)
    return trail.select("grant_id", "event_id", F.col("__op").alias("op"))


@query
def version_trail_of_key(spark: SparkSession, sf: str) -> DataFrame:
    """A11 for the key whose period started last."""
    history = materialize(_history(spark, sf), "history")
    return temporal.version_trail(history, **_one(history, "grant_id"))


@query
def asof_batched(spark: SparkSession, sf: str) -> DataFrame:
    """One probe per order, its date moved into the month of the events."""
    day = F.expr("datediff(o_orderdate, date'1970-01-01') % 30")
    second = F.expr("o_orderkey * 7919 % 86400")
    micros = F.lit(1_704_067_200_000_000) + (day * 86_400 + second) * 1_000_000
    probes = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("probe_id"),
        F.col("o_custkey").alias("grant_id"),
        F.timestamp_micros(micros).cast("timestamp_ntz").alias("probe_ts"),
    )
    return temporal.as_of_probes(_history(spark, sf), probes, ["grant_id"], "probe_ts")


@query
def asof_resource_daily(spark: SparkSession, sf: str) -> DataFrame:
    """A12 by resource, whose periods overlap: who could reach each at the start of each day."""
    history = materialize(_history(spark, sf), "history")
    probes = history.select(
        "resource_id", F.col("effective_start").cast("date").cast("timestamp_ntz").alias("probe_ts")
    ).distinct()
    return temporal.as_of_probes(
        history, probes, ["resource_id"], "probe_ts", tie=["grant_id"]
    ).select("resource_id", "probe_ts", "grant_id", "user_id", "role_id", "effective_start")


@query
def closed_in_range(spark: SparkSession, sf: str) -> DataFrame:
    """A5 over a day."""
    return temporal.ended_between(_history(spark, sf), INSTANT, SPLIT)


@query
def changes_at_instant(spark: SparkSession, sf: str) -> DataFrame:
    """A5 at one instant: the last time at which a period ended."""
    history = materialize(_history(spark, sf), "history")
    return temporal.ended_at(history, history.agg(F.max("effective_end")).first()[0])


@query
def removal_kind(spark: SparkSession, sf: str) -> DataFrame:
    """A6 for all periods."""
    return temporal.with_ending(_history(spark, sf))


@query
def removal_kind_stored(spark: SparkSession, sf: str) -> DataFrame:
    """A6 as two merges wrote it when they closed the periods."""
    path, store = scratch_path(spark, "bronze"), GoldStore(spark, scratch_path(spark, "gold"))
    for part in _halves(event_log(spark, sf)):
        bronze.append_bronze(part, path)
        run_merge(store, bronze.read_bronze(spark, path, EVENT_LOG))
    return store.history(endings=True).drop("end_day")


@query
def event_trail(spark: SparkSession, sf: str) -> DataFrame:
    """A10 for every key: its events, each with the one before."""
    log = event_log(spark, sf)
    rows = OrderedRuns(log, GRANTS.key, GRANTS.order).add(prev={"p": F.struct("event_id", "__op")})
    return rows.rows().select(
        "grant_id",
        "event_id",
        F.col("__op").alias("op"),
        F.col("__source_ts_ns").alias("source_ts_ns"),
        F.col("p.event_id").alias("previous_event_id"),
        F.col("p.__op").alias("previous_op"),
    )


@query
def version_trail(spark: SparkSession, sf: str) -> DataFrame:
    """A11 for every key: its periods by start, each with the role before."""
    rows = OrderedRuns(_history(spark, sf), GRANTS.key, temporal.PERIOD_ORDER).add(
        prev={"p": F.struct("role_id", "effective_end")}
    )
    return rows.rows().select(
        "grant_id",
        "role_id",
        "effective_start",
        "effective_end",
        F.col("p.role_id").alias("previous_role_id"),
        F.col("p.effective_end").alias("previous_end"),
    )


# -- checks ----------------------------------------------------------------------------


@query
def dup_current_guard(spark: SparkSession, sf: str) -> DataFrame:
    """No rows."""
    return checks.duplicate_current(_history(spark, sf))


@query
def dup_current_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A9 as numbers: what the guard looked at, and what it found."""
    per_key = (
        _history(spark, sf).filter("is_current").groupBy("grant_id").agg(_count().alias("n"))
    )
    return per_key.agg(
        _count().alias("keys_with_current"),
        F.sum("n").alias("current_rows"),
        _count(F.col("n") > 1).alias("violations"),
    )


@query
def idempotency_diff(spark: SparkSession, sf: str) -> DataFrame:
    """V1: three runs over one log (D1): sizes, and rows that differ from the run before."""
    path = scratch_path(spark, "bronze")
    bronze.append_bronze(event_log(spark, sf), path)
    store = GoldStore(spark, scratch_path(spark, "gold"))
    before = store.latest()
    found = []
    for run in (1, 2, 3):
        commit = run_merge(store, bronze.read_bronze(spark, path, EVENT_LOG))
        sizes, changed = audit.sizes(commit), audit.changed_rows(store, before, commit)
        for name, table_name in (("fact", FACT_TABLE), ("history", HISTORY_TABLE)):
            found.append((name, sizes[table_name], changed[table_name], run))
        before = commit
    return spark.createDataFrame(found, "table_name string, row_count long, changed_rows long, run int")


@query
def rewritten_without_change(spark: SparkSession, sf: str) -> DataFrame:
    """V1 where files differ and rows do not: two merges, then the closed periods gathered."""
    first, second = _halves(event_log(spark, sf))
    path, store = scratch_path(spark, "bronze"), GoldStore(spark, scratch_path(spark, "gold"))
    commits = [store.latest()]
    for part in (first, second):
        bronze.append_bronze(part, path)
        commits.append(run_merge(store, bronze.read_bronze(spark, path, EVENT_LOG)))
    commits.append(store.compact())
    found = []
    for step, (a, b) in zip(("merge", "merge again", "gather"), zip(commits, commits[1:])):
        found += [(step, name, n) for name, n in audit.changed_rows(store, a, b).items()]
    return spark.createDataFrame(found, "step string, table_name string, changed_rows long")


@query
def bronze_immutable(spark: SparkSession, sf: str) -> DataFrame:
    """V4: after a second append, no earlier row is gone; days without new files are not read."""
    path = scratch_path(spark, "bronze")
    first, second = _halves(event_log(spark, sf))
    bronze.append_bronze(first, path)
    before = materialize(audit.day_prints(spark, path, EVENT_LOG), "days-before")
    bronze.append_bronze(second, path)
    after = materialize(audit.day_prints(spark, path, EVENT_LOG, before), "days-after")
    broken = audit.broken_days(before, bronze.with_capture_day(second), after)
    found = [
        days.agg(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("row_count")).withColumn("table_name", F.lit(name))
        for name, days, n in (("before", before, "rows"), ("after", after, "rows"), ("lost", broken, "expected"))
    ]
    return reduce(DataFrame.unionByName, found).select("table_name", "row_count")


@query
def row_count_stored(spark: SparkSession, sf: str) -> DataFrame:
    """V3 of a stored run, by what its commit says."""
    found = audit.sizes(_stored(spark, sf).latest())
    return spark.createDataFrame(list(found.items()), "table_name string, row_count long")


@query
def row_count_report(spark: SparkSession, sf: str) -> DataFrame:
    """V3."""
    log = event_log(spark, sf)
    state = scd.current_state(log)
    return checks.row_counts(
        bronze=log,
        fact_access_grant=state,
        fact_access_grant_history=scd.access_history(log),
        current_active_access=temporal.active_access(state),
    )


@query
def period_sanity(spark: SparkSession, sf: str) -> DataFrame:
    """V7 on the order log, merged in arrival order so that business times run back."""
    return (
        checks.period_problems(_arrivals_merged(spark, sf), ORDERS)
        .groupBy("problem")
        .agg(_count().alias("periods"))
    )


@query
def period_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    """V7: the periods of the order log that an earlier one, next to it or not, reaches into."""
    found = checks.period_problems(_arrivals_merged(spark, sf), ORDERS)
    return found.filter(F.col("problem").contains("overlap")).select(
        "o_custkey", "effective_start", "effective_end", "problem"
    )


@query
def period_sanity_clean(spark: SparkSession, sf: str) -> DataFrame:
    """V7 on the event log, whose times only rise: no rows."""
    return checks.period_problems(_history(spark, sf))


@query
def view_vs_history(spark: SparkSession, sf: str) -> DataFrame:
    """V6: soft-deleted keys and rows that arrived revoked."""
    log = event_log(spark, sf)
    return checks.view_against_history(scd.current_state(log), scd.access_history(log))


@query
def quarantined_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Envelopes with an unknown or no op, without key, time or capture time, or broken."""

    def every(n: int):
        return F.col("event_id") % n == 0

    op = F.col("__op")
    bad = event_log(spark, sf).withColumns(
        {
            "__op": F.when(every(7), F.lit("t")).when(op == "r", F.lit(None)).otherwise(op),
            "__source_ts_ns": F.when(~every(13), F.col("__source_ts_ns")),
            "updated_at": F.when(~every(17), F.col("updated_at")),
            "grant_id": F.when(~every(19), F.col("grant_id")),
        }
    )
    sent = cdc.to_envelope(bad, EVENT_ROW).withColumn(
        "value", F.when(every(23), F.lit("{broken")).otherwise(F.col("value"))
    )
    fit, unfit = batch.split_quarantine(
        batch.stage(cdc.flatten_cdc(sent, EVENT_ROW, sequence="event_id"))
    )
    return (
        fit.withColumn("reason", F.lit(""))
        .unionByName(unfit)
        .groupBy("reason", "op")
        .agg(_count().alias("events"))
    )


@query
def event_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """V8 on a log whose views come with an unknown op and whose first events lack one."""
    log = event_log(spark, sf)
    kinds = table(spark, sf, "events").select("event_id", "event_type")
    op = (
        F.when(F.col("event_type") == "view", F.lit("t"))
        .when(F.col("__op") == "r", F.lit(None))
        .otherwise(F.col("__op"))
    )
    broken = log.join(kinds, "event_id").withColumn("__op", op)
    fit, unfit = batch.split_quarantine(batch.stage(broken))
    return (
        fit.withColumn("reason", F.lit(""))
        .unionByName(unfit)
        .groupBy("reason", "op")
        .agg(_count().alias("events"))
    )


@query
def double_load(spark: SparkSession, sf: str) -> DataFrame:
    """V9 on a log whose second half was loaded twice."""
    log = event_log(spark, sf).select(
        "event_id", "grant_id", F.col("__op").alias("op"), F.col("__source_ts_ns").alias("source_ts_ns")
    )
    return checks.loaded_more_than_once(
        log.unionByName(log.filter(F.col("source_ts_ns") >= SPLIT_NS))
    )


@query
def business_assertions(spark: SparkSession, sf: str) -> DataFrame:
    """V2: nine answers from gold against the same numbers taken from the events."""
    log = materialize(event_log(spark, sf), "event-log")  # read seven times
    return _assertions(log, scd.access_history(log), scd.current_state(log))


@query
def business_assertions_stored(spark: SparkSession, sf: str) -> DataFrame:
    """V2 of gold that two merges stored, asked for by name by another session."""
    database = f"iam_{uuid.uuid4().hex}"
    path, store = scratch_path(spark, "bronze"), GoldStore(spark, scratch_path(spark, "gold"))
    for part in _halves(event_log(spark, sf)):
        bronze.append_bronze(part, path)
        run_merge(store, bronze.read_bronze(spark, path, EVENT_LOG))
    catalog.publish_tables(store, database)
    other = spark.newSession()
    gold = [other.table(f"{database}.{name}") for name in (HISTORY_TABLE, FACT_TABLE)]
    return _assertions(bronze.read_bronze(other, path, EVENT_LOG), *gold)


def _assertions(log: DataFrame, history: DataFrame, fact: DataFrame) -> DataFrame:
    staged = batch.stage(log)
    last = batch.latest_per_key(staged)
    at_instant = batch.latest_per_key(staged.filter(F.col("business_ts") <= ntz(INSTANT)))
    keeps, gone = ~F.col("closes_access"), F.col("op") == "d"
    live = ~gone & F.col("revoked_at").isNull() & ~F.col("is_deleted")
    followed = OrderedRuns(staged, GRANTS.key, GRANTS.order).add(prev={"p": F.struct("closes_access")})
    ends = gone & ~F.col("p.closes_access")
    expected = [
        checks.tally(at_instant, subjects_with_access_at_instant=_count(keeps)),
        checks.tally(
            last,
            revoked_yet_current=F.lit(0) * _count(),
            deleted_yet_current=F.lit(0) * _count(),
            keys_with_two_current=F.lit(0) * _count(),
            keys_with_access_now=_count(keeps),
            keys_in_source=_count(~gone),
            active_in_view=_count(live),
        ),
        checks.tally(followed.rows(), periods_ended_by_hard_delete=_count(ends)),
        checks.tally(staged, periods_in_history=_count(keeps)),
    ]
    current = history.filter("is_current").groupBy("grant_id").agg(_count().alias("n"))
    judged = current.join(last.select("grant_id", "op", "closes_access"), "grant_id")
    actual = [
        checks.tally(
            history,
            subjects_with_access_at_instant=_count(covers(INSTANT)),
            periods_ended_by_hard_delete=_count(F.col("is_deleted") & ~F.col("is_current")),
            periods_in_history=_count(),
            keys_with_access_now=_count(F.col("is_current")),
        ),
        checks.tally(
            judged,
            revoked_yet_current=_count(F.col("closes_access") & ~gone),
            deleted_yet_current=_count(gone),
            keys_with_two_current=_count(F.col("n") > 1),
        ),
        checks.tally(fact, keys_in_source=_count()),
        checks.tally(temporal.active_access(fact), active_in_view=_count()),
    ]
    return checks.assert_equal(
        reduce(DataFrame.unionByName, expected), reduce(DataFrame.unionByName, actual)
    )


# -- sources ---------------------------------------------------------------------------


@query
def flatten_envelope(spark: SparkSession, sf: str) -> DataFrame:
    """The log as JSON envelopes, flattened again."""
    log = event_log(spark, sf)
    return cdc.flatten_cdc(cdc.to_envelope(log, EVENT_ROW), EVENT_ROW, sequence="event_id")


@query
def route_tables(spark: SparkSession, sf: str) -> DataFrame:
    """S3: events of two captured tables, only one of them listed, to its bronze name."""
    other = event_log(spark, sf).withColumn("__table", F.lit("login_attempts"))
    captured = event_log(spark, sf).unionByName(other)
    name = bronze.bronze_name("dev.iam", "public", TABLE)
    return (
        bronze.only_tables(captured, [TABLE])
        .groupBy(F.lit(name).alias("bronze_table"), F.col("__db").alias("db"))
        .agg(_count().alias("events"))
    )


@query
def routed_by_table(spark: SparkSession, sf: str) -> DataFrame:
    """S3: a folder for each of two listed tables; the unlisted and the unnamed are set apart."""
    part = F.col("event_id") % 4
    name = F.when(part == 0, TABLE).when(part == 1, "logins").when(part == 2, "unlisted")
    root, names = scratch_path(spark, "by-table"), {TABLE: "grants", "logins": "logins"}
    bronze.append_by_table(event_log(spark, sf).withColumn("__table", name), root, names, 0)
    return checks.row_counts(
        **{
            folder: bronze.read_bronze(spark, f"{root}/{folder}/load=0", EVENT_LOG)
            for folder in (*names.values(), bronze.REJECTED)
        }
    )


@query
def completeness_gate(spark: SparkSession, sf: str) -> DataFrame:
    """What the gate says of the whole log, asked for as many rows as it has and one more."""
    log = event_log(spark, sf)
    n = table(spark, sf, "events").count()
    said = []
    for least in (n, n + 1):
        try:
            snapshots.require_rows(log, least)
            said.append((least, True))
        except RuntimeError:
            said.append((least, False))
    return spark.createDataFrame(said, "least long, passed boolean")


def _source_at(log: DataFrame) -> DataFrame:
    """The source table once the log's events have happened."""
    rows = batch.latest_per_key(log).filter(F.col("__op") != "d")
    return rows.select(*GRANTS.fact_columns)


def _snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    log = event_log(spark, sf)
    return _source_at(_halves(log)[0]), _source_at(log)


@query
def snapshot_then_live(spark: SparkSession, sf: str) -> DataFrame:
    """The table at SPLIT enters as snapshot events, then the live changes."""
    first, second = _halves(event_log(spark, sf))
    seed = bronze.snapshot_events(_source_at(first), SPLIT_NS - 1, TABLE, DB)
    return scd.access_history(seed.unionByName(second.select(*seed.columns)))


@query
def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    """The changes between the source at SPLIT and at the end."""
    old, new = _snapshots(spark, sf)
    return snapshots.diff_snapshots(old, new, GRANTS.key, SPLIT_NS)


@query
def snapshot_diff_stored(spark: SparkSession, sf: str) -> DataFrame:
    """S5 between two saved snapshots, by the buckets that differ."""
    database = f"snapshots_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    names = [f"{database}.before", f"{database}.after"]
    for name, rows in zip(names, _snapshots(spark, sf), strict=True):
        snapshots.save_snapshot(rows, name, GRANTS.key, 8, scratch_path(spark, "snapshot"))
    return snapshots.diff_stored(spark, *names, GRANTS.key, SPLIT_NS)


@query
def incremental_missed(spark: SparkSession, sf: str) -> DataFrame:
    """Hard deletes, which an updated_at extract does not show."""
    old, new = _snapshots(spark, sf)
    changes = snapshots.diff_snapshots(old, new, GRANTS.key, SPLIT_NS)
    extract = snapshots.incremental_extract(new, SPLIT)
    return snapshots.missed_changes(changes, extract, GRANTS.key).select(
        "grant_id", F.col("__op").alias("op")
    )


@query
def changes_applied(spark: SparkSession, sf: str) -> DataFrame:
    """The source at SPLIT with its later changes is the source at the end."""
    old, new = _snapshots(spark, sf)
    changes = snapshots.diff_snapshots(old, new, GRANTS.key, SPLIT_NS)
    return snapshots.apply_changes(old, changes, GRANTS.key)


@query
def seed_missing_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Rows at the end whose key the table at SPLIT lacked."""
    old, new = _snapshots(spark, sf)
    return snapshots.missing_rows(new, old, GRANTS.key)


# -- late and tied events --------------------------------------------------------------


def _arrival_halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The order log in two arrivals of equal size (order keys run from 0 without gaps)."""
    log = order_log(spark, sf)
    middle = table(spark, sf, "orders").count() // 2
    return log.filter(F.col("o_orderkey") < middle), log.filter(F.col("o_orderkey") >= middle)


def _arrivals_merged(spark: SparkSession, sf: str) -> DataFrame:
    first, second = [
        batch.relate_events(batch.stage(half, ORDERS), ORDERS)
        for half in _arrival_halves(spark, sf)
    ]
    after_first = scd.scd2_merge(None, first, ORDERS)
    after_second = scd.scd2_merge(after_first.filter("is_current"), second, ORDERS)
    return after_first.filter("NOT is_current").unionByName(after_second)


@query
def late_skipped(spark: SparkSession, sf: str) -> DataFrame:
    """What each kind of cursor skips of the second arrival."""
    first, second = _arrival_halves(spark, sf)
    reports = []
    for name, columns in (
        ("capture_time", ("__source_ts_ns",)),
        ("capture_time_and_sequence", ("__source_ts_ns", "o_orderkey")),
        ("arrival_position", ("o_orderkey",)),
    ):
        reached = first.agg(F.max(F.struct(*columns))).first()[0]
        taken = batch.beyond(columns, tuple(reached))
        reports.append(
            second.agg(
                F.lit(name).alias("cursor"),
                _count().alias("arrived"),
                _count(~taken).alias("skipped"),
            )
        )
    return reduce(DataFrame.unionByName, reports)


@query
def late_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Both arrivals merged by position; late events take their place by arrival."""
    return _arrivals_merged(spark, sf)


@query
def tie_order(spark: SparkSession, sf: str) -> DataFrame:
    """Events of a key with equal capture times, and which of them counts as the last."""
    log = order_log(spark, sf)
    return (
        log.groupBy("o_custkey", F.col("updated_at").alias("tied_at"))
        .agg(_count().alias("events"), F.max("o_orderkey").alias("last_event"))
        .filter("events > 1")
    )


@query
def scd2_tied_events(spark: SparkSession, sf: str) -> DataFrame:
    """E1 on the order log: ties are ordered by event number."""
    return scd.access_history(order_log(spark, sf), ORDERS)


# -- dimensions ------------------------------------------------------------------------


@query
def dim_user_latest(spark: SparkSession, sf: str) -> DataFrame:
    """A customer's last order status, its names, and a dense surrogate key."""
    last = dims.latest_dimension(
        table(spark, sf, "orders"),
        "o_custkey",
        ["o_orderstatus", "o_orderpriority"],
        ["o_orderdate", "o_orderkey"],
    )
    nation = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"), "n_regionkey"
    )
    region = table(spark, sf, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region")
    )
    dim = (
        last.withColumnRenamed("o_custkey", "c_custkey")
        .join(
            table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"),
            "c_custkey",
            "left",
        )
        .join(nation, "c_nationkey", "left")
        .join(region, "n_regionkey", "left")
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("user_name"),
            "nation",
            "region",
            "o_orderstatus",
            "o_orderpriority",
        )
    )
    return dims.dense_key(dim, "user_id", "user_sk")


@query
def dim_two_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of half the orders get keys; those new in the other half get the next ones."""
    orders = table(spark, sf, "orders")
    middle = orders.count() // 2
    loads = [
        dims.latest_dimension(
            orders.filter(part), "o_custkey", ["o_orderstatus"], ["o_orderdate", "o_orderkey"]
        )
        for part in (F.col("o_orderkey") < middle, F.lit(True))
    ]
    known = dims.dense_key(loads[0], "o_custkey", "user_sk")
    return dims.with_new_keys(known, loads[1], "o_custkey", "user_sk")


@query
def dim_hashed_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that any job can compute: as many as there are customers, and stable."""
    keyed = dims.hashed_key(table(spark, sf, "customer").select("c_custkey"), "c_custkey", "user_sk")
    again = dims.hashed_key(table(spark, sf, "orders").select("o_custkey"), "o_custkey", "order_sk")
    met = keyed.join(again.distinct(), F.col("user_sk") == F.col("order_sk"))
    return met.agg(
        _count().alias("customers_with_orders"),
        F.count_if(F.col("c_custkey") == F.col("o_custkey")).alias("same_customer"),
    )


@query
def dim_attribute_history(spark: SparkSession, sf: str) -> DataFrame:
    """Versions of a customer's order status, one per change of it."""
    return dims.attribute_history(
        table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus"),
        "o_custkey",
        ["o_orderdate", "o_orderkey"],
        ["o_orderstatus"],
        "o_orderdate",
    )


@query
def record_vs_access_change(spark: SparkSession, sf: str) -> DataFrame:
    """Events that change the record only, the access too, or neither."""
    return (
        dims.classify_changes(batch.stage(event_log(spark, sf)))
        .groupBy("op", "record_changed", "access_changed")
        .agg(_count().alias("events"))
    )


@query
def access_change_history(spark: SparkSession, sf: str) -> DataFrame:
    """History whose periods start only where a column that makes out access changed."""
    staged = batch.stage(event_log(spark, sf))
    access = ["user_id", "role_id", "resource_id", "revoked_at", "is_deleted"]
    changed = dims.changed_only(staged, GRANTS.key, GRANTS.order, ["closes_access", *access])
    return scd.opened_periods(batch.relate_events(changed))


@query
def access_change_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The same in two stored runs, whose second compares with what the first left open."""
    store, path = GoldStore(spark, scratch_path(spark, "gold")), scratch_path(spark, "bronze")
    for part in _halves(event_log(spark, sf)):
        bronze.append_bronze(part, path)
        run_merge(store, bronze.read_bronze(spark, path, EVENT_LOG), changes="access")
    return store.history().drop("end_day")


def _two_loads(spark: SparkSession, sf: str) -> GoldStore:
    """Facts and dimensions from the two halves of the log with names."""
    path = scratch_path(spark, "bronze")
    store = GoldStore(spark, scratch_path(spark, "gold"), dimensions=GRANT_DIMENSIONS)
    earlier = named_log(spark, sf, before_ns=SPLIT_NS)  # without deriving the later events as well
    for part in (earlier, _halves(named_log(spark, sf))[1]):
        bronze.append_bronze(part, path)
        run_merge(store, bronze.read_bronze(spark, path, NAMED_LOG))
    return store


def _dimension_by_name(spark: SparkSession, sf: str, name: str) -> DataFrame:
    database = f"iam_{uuid.uuid4().hex}"
    catalog.publish_tables(_two_loads(spark, sf), database)
    return spark.newSession().sql(f"SELECT * FROM {database}.{name}")


@query
def dim_user_in_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Versions of users from two merges, by name."""
    return _dimension_by_name(spark, sf, "dim_user")


@query
def dim_role_in_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Versions of roles from two merges, by name; all roles are known from the first."""
    return _dimension_by_name(spark, sf, "dim_role")


@query
def history_with_user(spark: SparkSession, sf: str) -> DataFrame:
    """Periods with what was known of their user when they started."""
    store = _two_loads(spark, sf)
    user = GRANT_DIMENSIONS[0]
    facts = store.history().select("grant_id", "user_id", "role_id", "effective_start")
    return dimensions.described(facts, store.dimension(user), user).select(
        "grant_id", "role_id", "effective_start", "user_id", "user_sk", "user_name", "user_email"
    )
