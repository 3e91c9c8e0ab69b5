"""Capture: flattening, routing, snapshots, extracts, seeding, JDBC options."""

import json

import pytest
from pyspark.sql import functions as F

import narrative as story
from grantchron.model import BRONZE_TABLE, GRANTS, SOURCE_SCHEMA
from grantchron.operators import batch, checks, scd
from grantchron.sources import bronze, cdc, relational, snapshots


def messages(spark, *values):
    rows = [(i, None if v is None else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "event_id bigint, value string")


def test_flatten_round_trip(spark):
    log = story.bronze(spark)
    flat = cdc.flatten_cdc(cdc.to_envelope(log, SOURCE_SCHEMA), SOURCE_SCHEMA, sequence="event_id")
    assert checks.differences(log, flat).isEmpty()
    bare = cdc.to_envelope(log, SOURCE_SCHEMA, with_schema=False)
    again = cdc.flatten_cdc(bare, SOURCE_SCHEMA, sequence="event_id", with_schema=False)
    assert checks.differences(log, again).isEmpty()


def test_flatten_delete_tombstone_and_garbage(spark):
    source = {"ts_ns": 1767225600123456789, "table": "iam_denormalized", "db": "iam_source"}
    delete = {"payload": {"before": {"grant_id": 5}, "after": None, "op": "d", "source": source}}
    update = {"payload": {"before": None, "op": "u", "source": source,
                          "after": {"grant_id": 6, "updated_at": 1767225600000007}}}
    rows = messages(spark, delete, None, update).unionByName(
        spark.createDataFrame([(9, "not json")], "event_id bigint, value string")
    )
    flat = {r["event_id"]: r for r in
            cdc.flatten_cdc(rows, SOURCE_SCHEMA, sequence="event_id").collect()}
    assert set(flat) == {0, 2, 9}
    assert (flat[0]["grant_id"], flat[0]["user_id"], flat[0]["__deleted"]) == (5, None, "true")
    assert flat[0]["__source_ts_ns"] == 1767225600123456789
    assert flat[2]["updated_at"].microsecond == 7 and flat[2]["__deleted"] == "false"
    assert flat[9]["__op"] is None


@pytest.mark.parametrize("unit, value", [("millis", 1767225600000), ("iso", "2026-01-01T00:00:00")])
def test_other_time_units(spark, unit, value):
    update = {"before": None, "op": "c", "after": {"grant_id": 6, "updated_at": value}}
    flat = cdc.flatten_cdc(messages(spark, update), SOURCE_SCHEMA, time_unit=unit, with_schema=False)
    assert flat.first()["updated_at"] == story.at(1, 1)


def test_routing_names(spark):
    assert bronze.bronze_name("dev.iam", "public", "iam_denormalized") == BRONZE_TABLE
    other = story.bronze(spark).withColumn("__table", F.lit("sessions"))
    both = story.bronze(spark).unionByName(other)
    assert bronze.only_tables(both, ["sessions"]).count() == 9


def test_loads_by_table_can_be_repeated(spark, folder):
    other = story.bronze(spark).withColumn("__table", F.lit("sessions"))
    both = story.bronze(spark).unionByName(other)
    for load in (0, 0, 1):
        bronze.append_by_table(both, folder, {"sessions": "bronze_sessions"}, load)
    assert spark.read.parquet(folder + "/bronze_sessions").count() == 18


def test_append_only(spark, folder):
    bronze.append_bronze(story.bronze(spark, range(1, 4)), folder + "/b")
    bronze.append_bronze(story.bronze(spark, range(4, 10)), folder + "/b")
    after = bronze.read_bronze(spark, folder + "/b")
    assert after.count() == 9
    assert checks.lost_rows(story.bronze(spark, range(1, 4)), after).isEmpty()
    assert checks.lost_rows(story.bronze(spark), after.filter("event_id > 1")).count() == 1
    bronze.append_bronze(story.bronze(spark, range(8, 10)), folder + "/b")
    twice = checks.loaded_more_than_once(bronze.read_bronze(spark, folder + "/b"))
    assert sorted((r["event_id"], r["copies"]) for r in twice.collect()) == [(8, 2), (9, 2)]


def test_snapshot_differences_are_the_story(spark):
    """Successive snapshots give back every event, with a key-only delete."""
    for n in range(4, 10):
        old, new = story.source_after(spark, n - 1), story.source_after(spark, n)
        changes = snapshots.diff_snapshots(old, new, ["grant_id"], story.capture_ns(n))
        got = changes.drop("event_id").collect()
        wanted = story.bronze_row(n)
        assert len(got) == 1 and got[0]["__op"] == wanted[14]
        assert tuple(got[0][c] for c in SOURCE_SCHEMA.names) == wanted[:14]
        rebuilt = snapshots.apply_changes(old, changes, ["grant_id"])
        assert checks.differences(new, rebuilt).isEmpty()


def test_extract_does_not_see_the_hard_delete(spark):
    old, new = story.source_after(spark, 6), story.source_after(spark, 7)
    changes = snapshots.diff_snapshots(old, new, ["grant_id"], 0)
    extract = snapshots.incremental_extract(new, "2026-02-15 00:00:00")
    missed = snapshots.missed_changes(changes, extract, ["grant_id"]).collect()
    assert [(r["grant_id"], r["__op"]) for r in missed] == [(5, "d")]


def test_snapshot_enters_before_live_changes(spark):
    seed = bronze.snapshot_events(story.source_after(spark, 3), 5, "iam_denormalized", "iam_source")
    assert {r["__op"] for r in seed.collect()} == {"r"}
    live = story.bronze(spark, range(4, 10)).select(*seed.columns)
    history = scd.access_history(seed.unionByName(live))
    assert story.history_rows(history) == story.HISTORY
    assert batch.latest_per_key(seed, GRANTS).count() == 3


def test_gate_and_guarded_seed(spark, folder):
    with pytest.raises(RuntimeError, match="at least 10 rows, found 9"):
        snapshots.require_rows(story.bronze(spark), 10)
    snapshots.require_rows(story.bronze(spark), 9)
    source, target = story.source_after(spark, 3), folder + "/fact"
    source.limit(0).write.parquet(target)
    for _ in range(2):
        snapshots.seed_missing(source, target, ["grant_id"])
    assert spark.read.parquet(target).count() == 3


def test_jdbc_read_is_split():
    got = relational.jdbc_options(
        "jdbc:postgresql://db/iam", "public.iam_denormalized", "grant_id", 1, 9_000_000, 64, user="u"
    )
    assert got["partitionColumn"] == "grant_id" and got["numPartitions"] == "64"
    assert got["fetchsize"] == "10000" and got["user"] == "u"
