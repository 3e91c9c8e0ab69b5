"""No event lost, none merged twice: new checkpoints, seeds, bad events, old stores."""

from dataclasses import replace

import narrative as story
from grantchron.functions.times import capture_ns
from grantchron.model import SOURCE_SCHEMA
from grantchron.operators import scd
from grantchron.plans.merge import run_merge
from grantchron.plans.store import Commit, GoldStore
from grantchron.sources import bronze, cdc
from grantchron.streaming import streams
from pyspark.sql import functions as F


def follow(store, log, checkpoint):
    streams.finish(streams.stream_to_gold(store, log, checkpoint))


def test_a_new_checkpoint_merges_only_what_is_new(spark, folder):
    log, store = folder + "/bronze", GoldStore(spark, folder + "/gold", buckets=2)
    for events, checkpoint in ((range(1, 6), "a"), (range(6, 10), "b"), ((), "c")):
        if events:
            bronze.append_bronze(story.bronze(spark, events), log)
        follow(store, log, f"{folder}/{checkpoint}")
    assert story.history_rows(store.history()) == story.HISTORY
    assert len(store.latest().streams) == 3


def test_a_stream_after_a_seed(spark, folder):
    log, store = folder + "/bronze", GoldStore(spark, folder + "/gold", buckets=2)
    bronze.append_bronze(story.bronze(spark, range(1, 6)), log)
    run_merge(store, bronze.read_bronze(spark, log))
    bronze.append_bronze(story.bronze(spark, range(6, 10)), log)
    follow(store, log, folder + "/cp")
    run_merge(store, bronze.read_bronze(spark, log))
    assert story.history_rows(store.history()) == story.HISTORY


def test_compacted_identities_still_guard(spark, folder):
    log, store = folder + "/bronze", GoldStore(spark, folder + "/gold", buckets=2)
    for events in (range(1, 4), range(4, 7), range(7, 10)):
        bronze.append_bronze(story.bronze(spark, events), log)
        run_merge(store, bronze.read_bronze(spark, log))
    store.compact()
    store.vacuum(keep_versions=1)
    assert len(store.latest().taken) == 1
    follow(store, log, folder + "/cp")
    assert story.history_rows(store.history()) == story.HISTORY


def test_a_late_event_still_passes_a_new_checkpoint(spark, folder):
    log, store = folder + "/bronze", GoldStore(spark, folder + "/gold", buckets=2)
    bronze.append_bronze(story.bronze(spark, [1, 2, 5, 6, 7, 8, 9]), log)
    run_merge(store, bronze.read_bronze(spark, log))
    bronze.append_bronze(story.bronze(spark, [3]), log)
    follow(store, log, folder + "/cp")
    assert 3 in story.grants(store.history())


def test_events_without_capture_time_are_quarantined_once(spark, folder):
    log, store = folder + "/bronze", GoldStore(spark, folder + "/gold", buckets=2)
    lost = story.bronze(spark, [4]).withColumn("__source_ts_ns", F.lit(None).cast("long"))
    bronze.append_bronze(story.bronze(spark, range(1, 4)).unionByName(lost), log)
    for _ in range(3):
        run_merge(store, bronze.read_bronze(spark, log))
    assert [r.reason for r in store.quarantine().collect()] == ["capture_time"]
    assert store.history().count() == 3


def test_a_micro_batch_of_bad_events_only(spark, folder):
    log, store = folder + "/bronze", GoldStore(spark, folder + "/gold", buckets=2)
    lost = story.bronze(spark, [4, 5]).withColumn("__source_ts_ns", F.lit(None).cast("long"))
    bronze.append_bronze(lost, log)
    follow(store, log, folder + "/cp")
    assert store.quarantine().count() == 2
    bronze.append_bronze(story.bronze(spark), log)
    follow(store, log, folder + "/cp")
    assert story.history_rows(store.history()) == story.HISTORY


def test_messages_that_do_not_parse_reach_quarantine(spark, folder):
    raw, log = folder + "/raw", folder + "/bronze"
    good = cdc.to_envelope(story.bronze(spark), SOURCE_SCHEMA)
    broken = spark.createDataFrame([(100, "{not json"), (101, "[]")], "event_id long, value string")
    good.unionByName(broken).write.parquet(raw)
    streams.finish(
        streams.stream_to_bronze(
            streams.read_messages(spark, raw), log, folder + "/cp1", SOURCE_SCHEMA, ["iam_denormalized"]
        )
    )
    store = GoldStore(spark, folder + "/gold", buckets=2)
    run_merge(store, bronze.read_bronze(spark, log))
    assert sorted(r.event_id for r in store.quarantine().collect()) == [100, 101]
    assert story.history_rows(store.history()) == story.HISTORY


def test_unlisted_and_unnamed_tables_are_set_apart(spark, folder):
    rows = story.bronze(spark, range(1, 5))
    names = F.when(F.col("event_id") == 1, "other").when(F.col("event_id") > 2, F.col("__table"))
    bronze.append_by_table(rows.withColumn("__table", names), folder, {"iam_denormalized": "grants"}, 0)
    assert bronze.read_bronze(spark, f"{folder}/grants/load=0").count() == 2
    assert bronze.read_bronze(spark, f"{folder}/{bronze.REJECTED}/load=0").count() == 2


def test_buckets_held_by_thousands_of_batches(spark, folder):
    rows = spark.range(10).select(
        F.col("id").cast("string").alias("batch"), F.col("id").cast("string").alias("slot")
    )
    live = GoldStore._live({str(i): str(i) for i in range(5, 5000)})
    assert rows.filter(live).count() == 5


def test_a_revocation_to_come_can_still_be_overtaken(spark, folder):
    """Granted on 2 January with revocation on the 11th; deleted on the 5th, one merge or two."""
    whole = story.bronze(spark, [1, 2])
    granted = whole.filter("grant_id = 2").withColumns(
        {
            "revoked_at": F.expr("updated_at + INTERVAL 9 DAY"),
            "__source_ts_ns": capture_ns(F.col("updated_at")),
        }
    )
    gone = granted.withColumns(
        {
            "__op": F.lit("d"),
            "__source_ts_ns": capture_ns(F.expr("updated_at + INTERVAL 3 DAY")),
            "event_id": F.col("event_id") + 50,
        }
    )
    at_once = scd.access_history(granted.unionByName(gone), prerevoked="closed").collect()
    log, store = folder + "/bronze", GoldStore(spark, folder + "/gold", buckets=2)
    for part in (granted, gone):
        bronze.append_bronze(part, log)
        run_merge(store, bronze.read_bronze(spark, log), prerevoked="closed")
    stored = store.history().drop("end_day").collect()
    assert stored == at_once and len(stored) == 1
    assert stored[0].is_deleted and not stored[0].is_current
    assert (stored[0].effective_end - stored[0].effective_start).days == 3


def test_capture_times_do_not_depend_on_the_session_zone(spark, folder):
    before = cdc.to_envelope(story.bronze(spark), SOURCE_SCHEMA).collect()
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert cdc.to_envelope(story.bronze(spark), SOURCE_SCHEMA).collect() == before
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_commits_of_before_are_still_read(spark, folder):
    store = GoldStore(spark, folder + "/gold")
    store.publish(replace(Commit(), version=1))
    assert store.latest().taken == []
