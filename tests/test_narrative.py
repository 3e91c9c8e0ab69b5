"""The golden story: sizes after each merge, final history, answers, assertions."""

import pytest
from pyspark.sql import functions as F

import narrative as story
from grantchron.functions.times import covers
from grantchron.operators import batch, checks, scd, temporal
from grantchron.plans.merge import run_merge
from grantchron.plans.store import GoldStore


@pytest.fixture(scope="module")
def merged(spark, tmp_path_factory):
    store = GoldStore(spark, str(tmp_path_factory.mktemp("gold")), buckets=2)
    run_merge(store, story.bronze(spark))
    return store


def test_merging_after_each_event(spark, folder):
    store = GoldStore(spark, folder + "/gold", buckets=2)
    seen = 0
    for events, n_batch, n_closed, n_opened, n_current, n_history in story.STEPS:
        before = store.history().count(), store.closed_periods().count()
        seen = events[-1]
        bronze = story.bronze(spark, range(1, seen + 1))
        fresh = batch.after_cursor(bronze, store.latest().cursor)
        assert fresh.count() == n_batch
        run_merge(store, bronze, mode="latest")
        assert store.closed_periods().count() - before[1] == n_closed
        assert store.history().count() - before[0] == n_opened
        assert store.current().count() == n_current
        assert store.history().count() == n_history
    version = store.latest()
    for _ in range(3):  # D1: not only the first run without news must change nothing
        assert run_merge(store, story.bronze(spark), mode="latest") == version
    assert story.history_rows(store.history()) == story.HISTORY


def test_all_events_in_one_batch(merged):
    assert story.history_rows(merged.history()) == story.HISTORY
    assert merged.current().count() == 5
    assert merged.history().filter("revoked_at IS NOT NULL").count() == 0  # D7


def test_latest_mode_in_one_batch_loses_history(spark):
    bronze = story.bronze(spark)
    assert story.grants(scd.access_history(bronze, mode="latest")) == [2, 4, 6]  # D2
    assert scd.current_state(bronze, mode="latest").count() == 5


def test_answers(merged):
    h, fact = merged.history(), merged.current()
    assert story.grants(temporal.as_of(h, "2026-01-31 23:59:00", user_id=101)) == [1]  # Q1
    assert story.grants(temporal.ended_at(h, "2026-02-01 08:00:00")) == [3]  # Q2
    assert story.grants(temporal.as_of(h, "2026-02-15 00:00:00", resource_id=501)) == [1]  # Q3
    removed = temporal.removal_history(h, user_id=104, resource_id=505).collect()  # Q4
    assert [(r["grant_id"], r["effective_end"], r["ending"]) for r in removed] == [
        (5, story.DELETED_AT, "hard_delete")
    ]
    assert temporal.existed_at(h, "2026-02-20 00:00:00", user_id=104).first()[0]  # Q5
    assert [r[0] for r in temporal.in_key_order(fact).collect()] == [1, 2, 3, 4, 6]  # Q6
    active = temporal.in_key_order(temporal.active_access(fact))
    assert [r[0] for r in active.collect()] == [2, 4, 6]  # Q6b
    assert checks.duplicate_current(h).isEmpty()  # Q8
    march = temporal.as_of(h, "2026-03-01 00:00:00", user_id=103, resource_id=503)
    assert march.isEmpty()  # Q9, D3
    ends = {r["grant_id"]: r["ending"] for r in temporal.with_ending(h).collect()}
    assert ends == {
        1: "revoked", 2: "open", 3: "revoked", 4: "open", 5: "hard_delete", 6: "open",
    }


def test_nine_assertions(spark, merged):
    h = merged.history()
    user, current = F.col("user_id"), F.col("is_current")
    carla = (user == 103) & (F.col("resource_id") == 503)
    two = checks.tally(checks.duplicate_current(h), two_current=F.count("grant_id"))
    actual = checks.tally(
        h,
        alice_jan_31=F.count_if((user == 101) & covers("2026-01-31 23:59:00")),
        carla_mar_1=F.count_if(carla & covers("2026-03-01 00:00:00")),
        contractor_feb_20=F.count_if((user == 104) & covers("2026-02-20 00:00:00")),
        contractor_hard_deleted=F.count_if((user == 104) & F.col("is_deleted") & ~current),
        history_rows=F.count(F.lit(1)),
        emma_now=F.count_if((user == 105) & current),
        bob_now=F.count_if((user == 102) & current),
    ).unionByName(two)
    active = temporal.active_access(merged.current())
    actual = actual.unionByName(checks.tally(active, active_grants=F.count("grant_id")))
    expected = spark.createDataFrame(
        [
            ("alice_jan_31", 1), ("carla_mar_1", 0), ("contractor_feb_20", 1),
            ("contractor_hard_deleted", 1), ("two_current", 0), ("history_rows", 6),
            ("emma_now", 1), ("bob_now", 1), ("active_grants", 3),
        ],
        "name string, value bigint",
    )
    results = checks.assert_equal(expected, actual)
    checks.require_all(results)
    assert results.count() == 9
    wrong = checks.assert_equal(expected.withColumn("value", F.col("value") + 1), actual)
    with pytest.raises(AssertionError, match="bob_now: expected 2, got 1"):
        checks.require_all(wrong)


def test_trails(spark, merged):
    trail = temporal.event_trail(story.bronze(spark), grant_id=3).collect()
    assert [(r["__op"], r["event_id"]) for r in trail] == [("r", 3), ("u", 4)]
    versions = temporal.version_trail(merged.history(), grant_id=5).collect()
    assert [(r["effective_end"], r["is_deleted"]) for r in versions] == [(story.DELETED_AT, True)]


def test_row_counts(spark, merged):
    counted = checks.row_counts(
        bronze=story.bronze(spark), fact=merged.current(), history=merged.history()
    )
    assert {tuple(r) for r in counted.collect()} == {("bronze", 9), ("fact", 5), ("history", 6)}
