"""Streams: envelopes to bronze to gold, resumed, repeated and equal to the batch result."""

import pytest

import narrative as story
from grantchron.model import BRONZE_SCHEMA, SOURCE_SCHEMA
from grantchron.operators import checks, scd
from grantchron.plans.merge import run_merge
from grantchron.plans.store import GoldStore
from grantchron.sources import bronze, cdc
from grantchron.streaming import streams


def send(spark, folder, events):
    cdc.to_envelope(story.bronze(spark, events), SOURCE_SCHEMA).write.mode("append").parquet(folder)


def test_events_reach_gold_one_by_one(spark, folder):
    store = GoldStore(spark, folder + "/gold", buckets=2)
    raw, log = folder + "/raw", folder + "/bronze"
    sizes = []
    for events, *_, n_current, n_history in story.STEPS:
        send(spark, raw, events)
        streams.finish(
            streams.stream_to_bronze(
                streams.read_messages(spark, raw), log, folder + "/cp1", SOURCE_SCHEMA,
                ["iam_denormalized"],
            )
        )
        streams.finish(
            streams.stream_to_gold(
                store, log, folder + "/cp2", mode="latest",
                after_batch=lambda s, _: sizes.append((s.current().count(), s.history().count())),
            )
        )
        assert sizes[-1] == (n_current, n_history)
    assert story.history_rows(store.history()) == story.HISTORY
    assert checks.differences(
        story.bronze(spark), bronze.read_bronze(spark, log).drop("capture_day")
    ).isEmpty()
    version, ran = store.latest(), []
    streams.finish(  # S9: nothing new, so no batch
        streams.stream_to_gold(
            store, log, folder + "/cp2", after_batch=lambda *a: ran.append(a)
        )
    )
    assert not ran and store.latest() == version


def test_backlog_in_one_run_keeps_every_event(spark, folder):
    log = folder + "/bronze"
    for events in (range(1, 6), range(6, 10)):
        bronze.append_bronze(story.bronze(spark, events).coalesce(1), log)
    store = GoldStore(spark, folder + "/gold")
    streams.finish(streams.stream_to_gold(store, log, folder + "/cp", files_per_trigger=100))
    assert story.history_rows(store.history()) == story.HISTORY
    whole = scd.access_history(story.bronze(spark))
    assert checks.differences(whole, store.history()).isEmpty()


def test_batch_that_fails_is_run_again_once(spark, folder):
    log = folder + "/bronze"
    bronze.append_bronze(story.bronze(spark), log)
    store = GoldStore(spark, folder + "/gold")

    def fail(*_):
        raise RuntimeError("after the commit, before the checkpoint")

    query = streams.stream_to_gold(store, log, folder + "/cp", after_batch=fail)
    with pytest.raises(Exception, match="before the checkpoint"):
        query.awaitTermination(300)
    version = store.latest()
    streams.finish(streams.stream_to_gold(store, log, folder + "/cp"))
    assert store.latest() == version
    assert story.history_rows(store.history()) == story.HISTORY


def test_late_file_is_merged_not_skipped(spark, folder):
    """Event 3 arrives after everything else; a time cursor would pass over it."""
    log = folder + "/bronze"
    by_stream, by_cursor = GoldStore(spark, folder + "/g1"), GoldStore(spark, folder + "/g2")
    for events in ([1, 2, 5, 6, 7, 8, 9], [3]):
        bronze.append_bronze(story.bronze(spark, events), log)
        streams.finish(streams.stream_to_gold(by_stream, log, folder + "/cp"))
        run_merge(by_cursor, bronze.read_bronze(spark, log))
    assert 3 in story.grants(by_stream.history()) and 3 not in story.grants(by_cursor.history())


def test_a_folder_for_each_table(spark, folder):
    raw = folder + "/raw"
    send(spark, raw, range(1, 10))
    names = {"iam_denormalized": "bronze_grants", "other": "bronze_other"}
    for _ in range(2):
        streams.finish(
            streams.stream_by_table(
                streams.read_messages(spark, raw), folder, folder + "/cp", SOURCE_SCHEMA, names
            )
        )
    assert spark.read.parquet(folder + "/bronze_grants").count() == 9
    got = spark.read.schema(BRONZE_SCHEMA).parquet(folder + "/bronze_other")
    assert got.count() == 0
