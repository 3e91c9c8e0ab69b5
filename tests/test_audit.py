"""Audits that read what changed, period checks, endings, and SQL questions with their plans."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import narrative as story
from grantchron.model import FACT_TABLE, HISTORY_SCHEMA, HISTORY_TABLE
from grantchron.operators import batch, checks, temporal
from grantchron.plans import audit, catalog
from grantchron.plans.merge import run_merge
from grantchron.plans.store import GoldStore, new_batch
from grantchron.plans.testdata import EVENT_LOG, event_log
from grantchron.session import materialize
from grantchron.sources import bronze, snapshots
from test_plans import plan
from test_semantics import day, event, log

SF = "/root/testdata/sf0.001"


def test_fingerprints_know_where_a_null_is(spark):
    def prints(*rows):
        return checks.fingerprints(spark.createDataFrame(rows, "a long, b long, p int"), "p").first()

    assert prints((1, None, 0)) != prints((None, 1, 0))
    assert prints((1, 2, 0), (3, 4, 0)) == prints((3, 4, 0), (1, 2, 0)) != prints((1, 2, 0), (1, 2, 0))


def test_a_run_without_news_reads_no_gold(spark, folder, monkeypatch):
    store = GoldStore(spark, folder + "/gold", buckets=4)
    first = run_merge(store, story.bronze(spark))
    with monkeypatch.context() as m:
        for reader in ("current", "open_periods", "closed_periods"):
            m.setattr(GoldStore, reader, lambda *a, **k: pytest.fail("read"))
        again = run_merge(store, story.bronze(spark))
        assert audit.changed_rows(store, first, again) == {FACT_TABLE: 0, HISTORY_TABLE: 0}
        assert audit.sizes(again) == {
            "bronze": 9, FACT_TABLE: 5, HISTORY_TABLE: 6, "current_active_access": 3,
        }


def test_one_changed_row_is_found_in_its_bucket(spark, folder):
    store = GoldStore(spark, folder + "/gold", buckets=16)
    before = run_merge(store, log(spark, *[event(i, "c", 0, key=i) for i in range(60)]))
    bucket = spark.sql("SELECT 7L AS grant_id").select(store.bucket()).first()[0]
    written = new_batch(2)
    rows = materialize(store.current(before, [bucket]), "bucket")
    store.write_current(rows.withColumn("role_id", F.when(F.col("grant_id") == 7, 9).otherwise(F.col("role_id"))), written)
    after = replace(before, version=2, current={**before.current, bucket: written})
    after = replace(after, prints=audit.prints_after(store, before, after, written))
    store.publish(after)
    assert audit.changed_parts(before, after)[FACT_TABLE].buckets == [bucket]
    assert audit.changed_rows(store, before, after) == {FACT_TABLE: 2, HISTORY_TABLE: 0}
    found = audit.differences(store, before, after, FACT_TABLE)
    assert sorted((r["grant_id"], r["role_id"], r["side"]) for r in found.collect()) == [(7, 1, "before"), (7, 9, "after")]
    # The same rows in other files count as the same.
    back = new_batch(3)
    store.write_current(rows, back)
    third = replace(after, version=3, current={**after.current, bucket: back})
    third = replace(third, prints=audit.prints_after(store, after, third, back))
    assert not any(p.to_read or p.known for p in audit.changed_parts(before, third).values())


def test_gathered_periods_are_known_to_be_the_same(spark, folder):
    store = GoldStore(spark, folder + "/gold", buckets=2)
    for last in (4, 6, 10):
        before = run_merge(store, story.bronze(spark, range(1, last)))
    after = store.compact()
    assert not any(p.to_read for p in audit.changed_parts(before, after).values())
    assert audit.changed_rows(store, before, after) == {FACT_TABLE: 0, HISTORY_TABLE: 0}
    assert audit.sizes(after) == audit.sizes(before)


def test_a_day_that_was_tampered_with_is_found(spark, folder):
    path = folder + "/bronze"
    events = event_log(spark, SF)
    bronze.append_bronze(events.filter("event_id < 500"), path)
    before = materialize(audit.day_prints(spark, path, EVENT_LOG), "days")
    assert audit.broken_days(before, bronze.with_capture_day(events.limit(0)), before).isEmpty()
    new = events.filter("event_id >= 500")
    bronze.append_bronze(new, path)
    after = materialize(audit.day_prints(spark, path, EVENT_LOG, before), "days")
    assert audit.broken_days(before, bronze.with_capture_day(new), after).isEmpty()
    assert after.agg(F.sum("rows")).first()[0] == 1000
    # One row of one day gets another role.
    rows = bronze.read_bronze(spark, path, EVENT_LOG)
    odd = rows.select("capture_day").first()[0]
    changed = materialize(rows.filter(F.col("capture_day") == odd), "day")
    least = changed.agg(F.min("event_id")).first()[0]
    role = F.when(F.col("event_id") == least, 99).otherwise(F.col("role_id"))
    changed.withColumn("role_id", role).drop("capture_day").write.mode("overwrite").parquet(f"{path}/capture_day={odd}")
    last = audit.day_prints(spark, path, EVENT_LOG, after)
    scans = [p for p in plan(last).splitlines() if "PartitionFilters" in p]
    assert scans and all(str(odd) in p for p in scans if "role_id" in p)  # no other day is read
    found = audit.broken_days(after, bronze.with_capture_day(new.limit(0)), last).collect()
    assert [r["capture_day"] for r in found] == [odd] and found[0]["expected"] == found[0]["found"]


@pytest.mark.parametrize("hot_limit", [None, 1, 3])
def test_periods_within_a_long_one_overlap_it(spark, hot_limit):
    def period(key, start, end):
        return (key, None, None, None, None, None, day(start), None if end is None else day(end), end is None, False)

    rows = [period(1, 1, 10), period(1, 2, 3), period(1, 4, 5), period(1, 10, 11), period(1, 12, None), period(1, 13, 14)]
    rows += [period(2, 1, 2), period(2, 2, 3), period(3, 5, 9), period(3, 6, 6)]
    history = spark.createDataFrame(rows, HISTORY_SCHEMA)
    found = {(r["grant_id"], r["effective_start"]): r["problem"] for r in
             checks.period_problems(history, hot_limit=hot_limit).collect()}
    assert found == {
        (1, day(2)): "overlap", (1, day(4)): "overlap", (1, day(13)): "overlap", (3, day(6)): "zero_length,overlap",
    }


def test_endings_are_written_when_periods_close(spark, folder):
    store = GoldStore(spark, folder + "/gold", buckets=2)
    done = []
    for more in (
        [event(1, "c", 0), event(2, "u", 1, role=2), event(3, "c", 0, key=2)],
        [event(4, "u", 3, role=2, revoked=day(3)), event(5, "d", 4, key=2)],
        [event(6, "c", 5), event(7, "c", 5, key=3)],
    ):
        done += more
        run_merge(store, log(spark, *done))
    found = sorted((r["grant_id"], r["effective_start"], r["ending"]) for r in store.history(endings=True).collect())
    assert found == [
        (1, day(0), "replaced"), (1, day(1), "revoked"), (1, day(5), "open"), (2, day(0), "hard_delete"),
        (3, day(5), "open"),
    ]
    wanted = temporal.with_ending(store.history().drop("end_day"))
    assert sorted(map(repr, wanted.collect())) == sorted(
        map(repr, store.history(endings=True).drop("end_day").collect())
    )
    assert "Exchange" not in plan(store.history(endings=True))
    store.compact()
    again = sorted((r["grant_id"], r["effective_start"], r["ending"]) for r in store.history(endings=True).collect())
    assert again == found


def test_sql_questions_open_the_days_they_ask_for(spark, folder):
    store = GoldStore(spark, folder + "/gold")
    run_merge(store, event_log(spark, SF))
    spark.sql("CREATE DATABASE IF NOT EXISTS iam_asked")
    try:
        catalog.publish_tables(store, "iam_asked")
        other = spark.newSession()
        other.sql("USE iam_asked")
        for question, wanted in (
            ("access_as_of(TIMESTAMP_NTZ'2024-01-15 00:00:00')", temporal.as_of(store.history(), "2024-01-15 00:00:00")),
            (
                "ended_between(TIMESTAMP_NTZ'2024-01-15 00:00:00', TIMESTAMP_NTZ'2024-01-16 00:00:00')",
                temporal.ended_between(store.history(), "2024-01-15 00:00:00", "2024-01-16 00:00:00"),
            ),
            ("ended_at(TIMESTAMP_NTZ'2024-01-15 00:00:00')", temporal.ended_at(store.history(), "2024-01-15 00:00:00")),
        ):
            asked = other.sql(f"SELECT * FROM {question}")
            assert sorted(map(repr, asked.drop("ending").collect())) == sorted(
                map(repr, wanted.drop("end_day").collect())
            )
            scans = [p for p in plan(asked).splitlines() if "FileScan" in p]
            closed = next(p for p in scans if "= false" in p or "NOT is_current" in p)
            assert "slot" in closed.split("PartitionFilters")[1].split("PushedFilters")[0]
        assert len(other.sql("SELECT * FROM fact_access_grant_history").columns) == 10
    finally:
        catalog.drop_star_schema(spark, "iam_asked")


def test_saved_snapshots_are_compared_without_a_shuffle(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS snaps")
    try:
        old = spark.range(1000).selectExpr("id AS grant_id", "id % 7 AS role_id", "cast(null AS string) AS note")
        new = old.filter("grant_id <> 5").withColumn("role_id", F.expr("if(grant_id = 77, 9, role_id)"))
        new = new.unionByName(spark.sql("SELECT 5000L AS grant_id, 1L AS role_id, 'x' AS note"))
        for name, rows in (("snaps.a", old), ("snaps.b", new), ("snaps.c", old.repartition(3))):
            snapshots.save_snapshot(rows, name, ["grant_id"], 32, f"{folder}/{name}")
        found = snapshots.diff_stored(spark, "snaps.a", "snaps.b", ["grant_id"], 1)
        assert sorted((r["grant_id"], r["__op"]) for r in found.collect()) == [(5, "d"), (77, "u"), (5000, "c")]
        assert sorted(map(repr, found.collect())) == sorted(
            map(repr, snapshots.diff_snapshots(old, new, ["grant_id"], 1).collect())
        )
        assert "Exchange" not in plan(found) and len(snapshots.unequal_buckets(spark, "snaps.a", "snaps.b")) <= 3
        assert snapshots.unequal_buckets(spark, "snaps.a", "snaps.c") == []
        assert snapshots.diff_stored(spark, "snaps.a", "snaps.c", ["grant_id"], 1).isEmpty()
    finally:
        spark.sql("DROP DATABASE snaps CASCADE")


def test_rows_without_position_are_asked_of_their_folder_only(spark, folder):
    bronze.append_bronze(event_log(spark, SF), folder + "/bronze")
    rows = bronze.read_bronze(spark, folder + "/bronze", EVENT_LOG)
    _, unplaced = batch.by_position(rows)
    filters = plan(unplaced).split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "isnull(capture_day" in filters and unplaced.isEmpty()
    bad = spark.createDataFrame([event(1, "c", 0)[:10] + (None,)], log(spark, event(1, "c", 0)).schema)
    _, unplaced = batch.by_position(bronze.with_capture_day(bad))
    assert unplaced.count() == 1


@pytest.mark.parametrize("hot_limit", [None, 40])
def test_probes_of_a_crowded_piece(spark, hot_limit):
    """One resource has half of all periods, all of them long."""
    periods = [(1 if i % 2 else i, i, day(i % 5), day(200 + i)) for i in range(400)]
    probes = [(k, day(d)) for k in (1, 2, 4) for d in range(0, 40, 4)]
    history = spark.createDataFrame(
        periods, "resource_id long, grant_id long, effective_start timestamp_ntz, effective_end timestamp_ntz"
    )
    asked = spark.createDataFrame(probes, "resource_id long, t timestamp_ntz")
    found = temporal.as_of_probes(history, asked, ["resource_id"], "t", tie=["grant_id"], hot_limit=hot_limit)
    wanted = sorted((k, t, p[1]) for k, t in probes for p in periods if p[0] == k and p[2] <= t < p[3])
    assert sorted((r["resource_id"], r["t"], r["grant_id"]) for r in found.collect()) == wanted
    assert ("__salt" in plan(found)) == (hot_limit is not None)
