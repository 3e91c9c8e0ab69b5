"""The gold store: atomic versions, buckets, pruning, compaction, quarantine."""

import pytest
from pyspark.sql import functions as F

import narrative as story
from grantchron.functions.times import ntz
from grantchron.model import (
    ACTIVE_VIEW,
    FACT_TABLE,
    GRANTS,
    HISTORY_TABLE,
    WATERMARK_TABLE,
    ChangeSpec,
)
from grantchron.operators import checks, temporal
from grantchron.operators.batch import after_cursor
from grantchron.plans import catalog
from grantchron.plans.merge import run_merge
from grantchron.plans.store import Commit, CommitConflict, GoldStore
from grantchron.sources import bronze
from test_semantics import day, event, log


def content(store):
    return story.history_rows(store.history()), story.grants(store.current())


def test_failure_between_writes_leaves_the_old_version(spark, folder, monkeypatch):
    store = GoldStore(spark, folder + "/gold", buckets=2)
    run_merge(store, story.bronze(spark, range(1, 6)))
    before, version = content(store), store.latest()

    def fail(self, rows, batch):
        raise RuntimeError("lost")

    for broken in ("write_history", "write_current"):
        with monkeypatch.context() as m:
            m.setattr(GoldStore, broken, fail)
            with pytest.raises(RuntimeError, match="lost"):
                run_merge(store, story.bronze(spark))
        assert store.latest() == version and content(store) == before
    run_merge(store, story.bronze(spark))
    assert content(store) == (story.HISTORY, [1, 2, 3, 4, 6])


def test_two_writers_cannot_publish_one_version(spark, folder):
    store = GoldStore(spark, folder + "/gold")
    store.publish(Commit(version=1, cursor=[5]))
    with pytest.raises(CommitConflict):
        store.publish(Commit(version=1, cursor=[9]))
    assert store.latest().cursor == [5]
    assert store.watermark().collect() == [(HISTORY_TABLE, 5)]


def test_empty_store(spark, folder):
    store = GoldStore(spark, folder + "/gold")
    assert store.history().isEmpty() and store.current().isEmpty() and store.watermark().isEmpty()
    assert run_merge(store, story.bronze(spark, [])).version == 0


def test_repeated_micro_batch_changes_nothing(spark, folder):
    store = GoldStore(spark, folder + "/gold")
    first = run_merge(store, story.bronze(spark, range(1, 4)), stream="s", batch_id=0)
    assert run_merge(store, story.bronze(spark, range(1, 4)), stream="s", batch_id=0) == first
    run_merge(store, story.bronze(spark, range(4, 10)), stream="s", batch_id=1)
    assert content(store)[0] == story.HISTORY
    empty = run_merge(store, story.bronze(spark, []), stream="s", batch_id=2)
    assert empty.streams == {"s": 2} and content(store)[0] == story.HISTORY


def test_only_touched_buckets_are_rewritten(spark, folder):
    store = GoldStore(spark, folder + "/gold", buckets=16)
    many = [event(i, "c", 0, key=i) for i in range(60)]
    first = run_merge(store, log(spark, *many))
    second = run_merge(store, log(spark, event(99, "u", 5, key=7, role=3)))
    bucket = spark.sql("SELECT 7L AS grant_id").select(store.bucket()).first()[0]
    assert {b for b in second.open if second.open[b] != first.open[b]} == {bucket}
    assert {b for b in second.current if second.current[b] != first.current[b]} == {bucket}
    assert store.current().count() == 60 and store.history().count() == 61
    assert store.current().filter("grant_id = 7").first()["role_id"] == 3


def test_closed_batches_compact_without_changing_answers(spark, folder):
    store = GoldStore(spark, folder + "/gold", buckets=2)
    for n in (3, 4, 7, 9):
        run_merge(store, story.bronze(spark, range(1, n + 1)))
    before = content(store)
    assert len(store.latest().closed) == 4
    store.compact()
    assert len(store.latest().closed) == 1 and content(store) == before
    run_merge(store, log(spark, event(50, "u", 365, key=2)))
    assert len(story.history_rows(store.history())) == 7


def test_vacuum_leaves_the_kept_versions_readable(spark, folder):
    store = GoldStore(spark, folder + "/gold", buckets=2)
    for n in (3, 4, 7, 9):
        run_merge(store, story.bronze(spark, range(1, n + 1)))
    older = store.commits(2)[1]
    before, before_older = content(store), story.history_rows(store.history(older))
    assert store.vacuum(keep_versions=2) > 0
    assert content(store) == before and story.history_rows(store.history(older)) == before_older
    assert store.vacuum(keep_versions=2) == 0
    store.vacuum(keep_versions=1)
    assert content(store) == before


def test_unfit_events_are_kept_apart_and_passed_over(spark, folder):
    store = GoldStore(spark, folder + "/gold")
    broken = story.bronze(spark).withColumn(
        "__op", F.when(F.col("event_id") == 9, F.lit("x")).otherwise(F.col("__op"))
    )
    commit = run_merge(store, broken)
    assert commit.cursor == [story.capture_ns(8)]  # an unfit event does not move it
    assert run_merge(store, broken) == commit
    assert [(r["grant_id"], r["reason"]) for r in store.quarantine().collect()] == [(6, "op")]
    assert story.grants(store.current()) == [1, 2, 3, 4]


def test_as_of_reads_only_days_from_the_instant_on(spark, folder):
    store = GoldStore(spark, folder + "/gold")
    run_merge(store, story.bronze(spark))
    live = temporal.as_of(store.history(), "2026-01-31 23:59:00")
    plan = live._jdf.queryExecution().executedPlan().toString()
    closed = next(p for p in plan.splitlines() if "NOT is_current" in p and "FileScan" in p)
    assert "cast(slot" in closed.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThan(effective_end" in closed and "LessThanOrEqual(effective_start" in closed
    assert story.grants(live) == [1, 2, 3]
    narrow = store.history().filter("is_current").select("grant_id").distinct()
    read = narrow._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<grant_id:bigint,effective_end:timestamp_ntz>" in read
    assert "user_id" not in read


def test_cursor_reaches_the_bronze_scan(spark, folder):
    path = folder + "/bronze"
    bronze.append_bronze(story.bronze(spark), path)
    log_ = bronze.read_bronze(spark, path)
    fresh = after_cursor(log_, (story.capture_ns(7),))
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThan(__source_ts_ns,{story.capture_ns(7)})" in plan
    assert "PartitionFilters: [isnotnull(capture_day" in plan and "capture_day#" in plan
    assert [r["event_id"] for r in fresh.orderBy("event_id").collect()] == [8, 9]


def test_idempotent_by_content(spark, folder):
    store = GoldStore(spark, folder + "/gold")
    one = run_merge(store, story.bronze(spark))
    for _ in range(3):
        again = run_merge(store, story.bronze(spark))
        assert checks.differences(store.history(one), store.history(again)).isEmpty()
        assert checks.differences(store.current(one), store.current(again)).isEmpty()
    other = store.current().withColumn("role_id", F.lit(9).cast("long"))
    assert checks.differences(store.current(), other).count() == 10


def test_views_over_the_newest_version(spark, folder):
    store = GoldStore(spark, folder + "/gold")
    run_merge(store, story.bronze(spark))
    catalog.publish_views(store, "v_")
    assert spark.table("v_" + ACTIVE_VIEW).count() == 3
    live = spark.sql(f"SELECT count(*) FROM v_{HISTORY_TABLE} WHERE is_current").first()[0]
    assert live == 3 and spark.table("v_" + FACT_TABLE).count() == 5
    assert spark.table("v_" + WATERMARK_TABLE).first()[1] == story.capture_ns(9)
    for name in (ACTIVE_VIEW, HISTORY_TABLE, FACT_TABLE, WATERMARK_TABLE):
        spark.catalog.dropTempView("v_" + name)


def test_reset(spark, folder):
    store = GoldStore(spark, folder + "/gold")
    run_merge(store, story.bronze(spark))
    store.reset()
    assert store.latest() == Commit() and store.history().isEmpty()


def test_position_cursor_takes_late_events(spark, folder):
    """Event 3 is captured before the others but arrives last, with the highest position."""
    late = story.bronze(spark).withColumn(
        "event_id", F.when(F.col("event_id") == 3, F.lit(30)).otherwise(F.col("event_id"))
    )
    found = []
    for spec in (GRANTS, ChangeSpec(cursor=("event_id",))):
        store = GoldStore(spark, f"{folder}/{spec.cursor[0]}", spec)
        run_merge(store, late.filter("event_id < 30"))
        found.append(run_merge(store, late).cursor)
        found.append(3 in story.grants(store.history()))
    assert found == [[story.capture_ns(9)], False, [30], True]


def test_star_schema_in_the_catalog(spark):
    catalog.drop_star_schema(spark, "iam_t")
    catalog.create_star_schema(spark, "iam_t")
    catalog.create_star_schema(spark, "iam_t")  # where they exist, nothing happens
    assert checks.missing_tables(spark, "iam_t", catalog.EXPECTED) == []
    state = [(1, 2, 3, 4, story.at(1, 5), None, story.at(1, 5), False),
             (2, 2, 3, 4, story.at(1, 6), story.at(2, 1), story.at(2, 1), False)]
    fact = spark.createDataFrame(state, spark.table(f"iam_t.{FACT_TABLE}").drop("updated_day").schema)
    catalog.append_by_day(fact, f"iam_t.{FACT_TABLE}", "updated_at", "updated_day")
    assert [r[0] for r in spark.table(f"iam_t.{ACTIVE_VIEW}").collect()] == [1]
    day = spark.table(f"iam_t.{FACT_TABLE}").filter(F.col("updated_day") <= ntz("2026-01-31").cast("date"))
    assert "PartitionFilters: [isnotnull(updated_day" in day._jdf.queryExecution().toString()
    assert day.count() == 1
    catalog.drop_star_schema(spark, "iam_t")
    spark.sql("CREATE DATABASE iam_t")
    assert set(checks.missing_tables(spark, "iam_t", catalog.EXPECTED)) == set(catalog.EXPECTED)
    catalog.drop_star_schema(spark, "iam_t")


def test_bucket_of_a_key_is_fixed(spark):
    store = GoldStore(spark, "/nowhere", GRANTS, buckets=4)
    got = spark.range(8).select(F.col("id").alias("grant_id")).select(store.bucket()).collect()
    assert {r[0] for r in got} <= {"0", "1", "2", "3"}


def test_named_tables_in_another_session_follow_merges(spark, folder):
    from grantchron.plans import catalog

    store, database = GoldStore(spark, folder + "/gold", buckets=2), "iam_named"
    catalog.create_star_schema(spark, database)
    catalog.publish_tables(store, database)  # of an empty store
    asks = spark.newSession()
    assert asks.table(f"{database}.fact_access_grant_history").count() == 0
    for events in (range(1, 6), range(6, 10)):
        run_merge(store, story.bronze(spark, range(1, max(events) + 1)))
        catalog.publish_tables(store, database)
    assert story.history_rows(asks.table(f"{database}.fact_access_grant_history")) == story.HISTORY
    assert story.grants(asks.table(f"{database}.current_active_access")) == [2, 4, 6]
    assert asks.table(f"{database}.gold_merge_watermark").count() == 1
    catalog.drop_star_schema(spark, database)


def test_a_store_needs_an_exclusive_rename(spark, folder, monkeypatch):
    from grantchron.plans import store as stores

    monkeypatch.setattr(stores, "ATOMIC_RENAME", ("hdfs",))
    with pytest.raises(ValueError, match="exclusive rename"):
        run_merge(GoldStore(spark, folder + "/gold"), story.bronze(spark))


def test_access_only_periods_over_merges(spark, folder):
    store = GoldStore(spark, folder + "/gold", buckets=2)
    merges = (
        [event(1, "c", 0), event(2, "u", 1, granted=day(-3))],
        [event(3, "u", 2, granted=day(-4)), event(4, "u", 3, role=2)],  # as before; then another role
        [event(5, "u", 4, role=2, revoked=day(4))],
        [event(6, "u", 5, role=2, revoked=day(4)), event(7, "d", 6)],  # nothing is open
        [event(8, "c", 7, role=2)],
        [event(9, "u", 8, role=2)],
    )
    done = []
    for more in merges:
        done += more
        run_merge(store, log(spark, *done), changes="access")
    found = sorted((r["effective_start"], r["effective_end"]) for r in store.history().collect())
    assert [f[:1] + f[1:] for f in found[:2]] == [(day(0), day(3)), (day(3), day(4))]
    assert found[2] == (day(7), None) and len(found) == 3
    assert [r["granted_at"] for r in store.current().collect()] == [day(0)] or store.current().count() == 1
    with pytest.raises(ValueError, match="access changes"):
        run_merge(store, log(spark, *done, event(10, "d", 9)))
    with pytest.raises(ValueError, match="prerevoked"):
        run_merge(store, log(spark, *done), changes="access", prerevoked="closed")


def test_many_batches_are_picked_by_predicate(spark, folder, monkeypatch):
    store = GoldStore(spark, folder + "/gold", buckets=2)
    for last in range(2, 10):
        run_merge(store, story.bronze(spark, range(1, last)))
    one_by_one = content(store)
    monkeypatch.setattr("grantchron.plans.store.MANY_BATCHES", 1)
    assert content(store) == one_by_one
    run_merge(store, story.bronze(spark))
    assert content(store) == (story.HISTORY, [1, 2, 3, 4, 6])
    text = store.closed_periods()._jdf.queryExecution().executedPlan().toString()
    assert "batch" in text.split("PartitionFilters")[1].split("PushedFilters")[0]
