"""Rules that are easy to get wrong, one test each."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import narrative as story
from grantchron.functions.times import capture_time
from grantchron.model import GRANTS, SOURCE_SCHEMA, ChangeSpec
from grantchron.operators import batch, checks, scd, temporal
from grantchron.sources import cdc

T0 = datetime(2026, 1, 1)
COLUMNS = (
    "event_id bigint, grant_id bigint, user_id bigint, role_id bigint, resource_id bigint, "
    "granted_at timestamp_ntz, revoked_at timestamp_ntz, updated_at timestamp_ntz, "
    "is_deleted boolean, __op string, __source_ts_ns bigint"
)


def day(n):
    return T0 + timedelta(days=n)


def ns(n):
    return int((day(n) - datetime(1970, 1, 1)).total_seconds()) * 1_000_000_000


def event(i, op, d, key=1, user=1, role=1, revoked=None, soft=False, granted=None):
    """Event number i, captured and made on day d."""
    if op == "d":
        return (i, key, *[None] * 7, "d", ns(d))
    when = day(d)
    return (i, key, user, role, 9, granted or when, revoked, when, soft, op, ns(d))


def log(spark, *events):
    return spark.createDataFrame(list(events), COLUMNS)


def periods(history):
    cols = ["effective_start", "effective_end", "is_current", "is_deleted"]
    return [tuple(r) for r in history.select(*cols).orderBy("effective_start").collect()]


def test_d1_cursor_survives_empty_batches(spark):
    bronze = log(spark, event(1, "c", 0))
    cursor = tuple(batch.cursor_after(bronze, None).first())
    for _ in range(3):
        cursor = tuple(batch.cursor_after(batch.after_cursor(bronze, cursor), cursor).first())
        assert cursor == (ns(0),)
    assert batch.cursor_after(bronze.limit(0), None).first()[0] is None


def test_d3_revocation_and_delete_close_and_open_nothing(spark):
    for last in (event(2, "u", 5, revoked=day(5)), event(2, "d", 5)):
        history = scd.access_history(log(spark, event(1, "c", 0), last))
        assert periods(history) == [(day(0), day(5), False, last[9] == "d")]


def test_d4_row_that_arrives_revoked(spark):
    bronze = log(spark, event(1, "r", 5, revoked=day(2)), event(2, "c", 3, key=2, revoked=day(8)))
    assert periods(scd.access_history(bronze)) == [
        (day(3), None, True, False), (day(5), None, True, False)
    ]
    assert periods(scd.access_history(bronze, prerevoked="closed")) == [
        (day(3), day(8), False, False)
    ]


def test_d5_soft_delete_stays_open_but_leaves_the_view(spark):
    bronze = log(spark, event(1, "c", 0), event(2, "u", 1, soft=True))
    history, fact = scd.access_history(bronze), scd.current_state(bronze)
    assert periods(history)[-1] == (day(1), None, True, True)
    assert temporal.active_access(fact).isEmpty()
    split = checks.view_against_history(fact, history).collect()
    assert [tuple(r) for r in split] == [(1, False, True)]


def test_d6_updates_keep_user_and_grant_time(spark):
    first = log(spark, event(1, "c", 0, user=7, granted=day(-9)))
    later = log(spark, event(2, "u", 3, user=8, role=2), event(3, "u", 4, user=9, role=3))
    stored = scd.current_state(first)
    merged = scd.scd1_merge(stored, batch.relate_events(batch.stage(later)))
    row = merged.first()
    assert (row["user_id"], row["granted_at"], row["role_id"], row["updated_at"]) == (
        7, day(-9), 3, day(4)
    )
    again = log(
        spark, event(2, "u", 3, user=8), event(3, "d", 4), event(4, "c", 5, user=9),
        event(5, "u", 6, user=10, role=5),
    )
    row = scd.scd1_merge(stored, batch.relate_events(batch.stage(again))).first()
    assert (row["user_id"], row["granted_at"], row["role_id"]) == (9, day(5), 5)


def test_unseen_key_may_arrive_as_update(spark):
    bronze = log(spark, event(1, "u", 0, user=4))
    assert scd.current_state(bronze).first()["user_id"] == 4
    assert scd.scd1_merge(None, batch.relate_events(batch.stage(log(spark, event(1, "d", 0))))).isEmpty()


def test_d7_d8_closed_row_keeps_revoked_null_and_takes_delete_flag(spark):
    bronze = log(spark, event(1, "c", 0, soft=True), event(2, "u", 2, revoked=day(2)))
    row = scd.access_history(bronze).first()
    assert row["revoked_at"] is None and row["is_deleted"] is False
    deleted = scd.access_history(log(spark, event(1, "c", 0), event(2, "d", 2))).first()
    assert deleted["is_deleted"] is True


def test_d9_delete_time_is_capture_time_with_micros_and_null_stays_null(spark):
    df = spark.createDataFrame([(1767225600123456789,), (None,)], "ns bigint")
    assert [r[0] for r in df.select(capture_time("ns")).collect()] == [
        datetime(2026, 1, 1, 0, 0, 0, 123456), None
    ]


def test_d10_e2_cursor_kinds(spark):
    first = log(spark, event(1, "c", 0), event(2, "c", 5, key=2))
    later = log(spark, event(3, "u", 5, key=2), event(4, "u", 1, key=1), event(5, "u", 6, key=1))
    both = first.unionByName(later)
    taken = {}
    for columns in (("__source_ts_ns",), ("__source_ts_ns", "event_id"), ("event_id",)):
        spec = ChangeSpec(cursor=columns)
        cursor = tuple(batch.cursor_after(first, None, spec).first())
        taken[columns] = {r["event_id"] for r in batch.after_cursor(both, cursor, spec).collect()}
    assert list(taken.values()) == [{5}, {3, 5}, {3, 4, 5}]


def test_d11_ties_go_by_event_number(spark):
    bronze = log(spark, event(2, "u", 0, role=2), event(1, "c", 0, role=1))
    assert batch.latest_per_key(batch.stage(bronze)).first()["role_id"] == 2
    assert scd.access_history(bronze).filter("is_current").first()["role_id"] == 2


def test_d13_start_counts_end_does_not(spark):
    history = scd.access_history(log(spark, event(1, "c", 0), event(2, "d", 5)))
    assert [temporal.as_of(history, day(d)).count() for d in (-1, 0, 4, 5)] == [0, 1, 1, 0]


def test_d14_periods_that_run_back_are_kept_and_reported(spark):
    back = (2, 1, 1, 2, 9, day(0), None, day(-3), False, "u", ns(1))
    same = (4, 2, 1, 2, 9, day(0), None, day(0), False, "u", ns(3))
    history = scd.access_history(
        log(spark, event(1, "c", 0), back, event(3, "c", 0, key=2), same)
    )
    found = {(r["grant_id"], r["effective_end"]): r["problem"] for r in
             checks.period_problems(history).collect()}
    assert found == {(1, day(-3)): "inverted,overlap", (2, day(0)): "zero_length"}


def test_d15_unfit_events_are_set_apart(spark):
    bronze = log(
        spark,
        event(1, "c", 0),
        (2, 1, 1, 1, 9, day(1), None, day(1), False, None, ns(1)),
        (3, 1, 1, 1, 9, day(1), None, day(1), False, "t", ns(1)),
        (4, None, 1, 1, 9, day(1), None, day(1), False, "u", ns(1)),
        (5, 1, 1, 1, 9, day(1), None, None, False, "u", ns(1)),
        (6, None, *[None] * 7, "d", None),
    )
    fit, unfit = batch.split_quarantine(batch.stage(bronze))
    assert [r["event_id"] for r in fit.collect()] == [1]
    assert {r["event_id"]: r["reason"] for r in unfit.collect()} == {
        2: "op", 3: "op", 4: "key", 5: "business_time", 6: "key,business_time,capture_time",
    }


def test_null_op_matches_the_statements_without_quarantine(spark):
    """An event without op closes the open row, opens none, and inserts none."""
    nameless = (2, 1, 5, 5, 5, day(1), None, day(1), False, None, ns(1))
    unseen = (3, 2, 5, 5, 5, day(1), None, day(1), False, None, ns(1))
    stored = scd.current_state(log(spark, event(1, "c", 0)))
    events = batch.relate_events(batch.stage(log(spark, nameless, unseen)), mode="latest")
    assert [(r["grant_id"], r["role_id"]) for r in scd.scd1_merge(stored, events).collect()] == [(1, 5)]
    open_rows = scd.access_history(log(spark, event(1, "c", 0)))
    after = scd.scd2_merge(open_rows, events)
    assert periods(after) == [(day(0), day(1), False, None)]


def test_unknown_mode_and_option(spark):
    with pytest.raises(ValueError):
        scd.access_history(story.bronze(spark), mode="some")
    with pytest.raises(ValueError):
        scd.access_history(story.bronze(spark), prerevoked="maybe")


def test_results_do_not_depend_on_the_session_zone(spark):
    messages = cdc.to_envelope(story.bronze(spark), SOURCE_SCHEMA).persist()
    messages.count()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        history = scd.access_history(story.bronze(spark))
        assert story.history_rows(history) == story.HISTORY
        assert story.grants(temporal.as_of(history, "2026-02-15 00:00:00", resource_id=501)) == [1]
        flat = cdc.flatten_cdc(messages, SOURCE_SCHEMA, sequence="event_id")
        assert checks.differences(story.bronze(spark), flat).isEmpty()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        messages.unpersist()


def test_composite_key(spark):
    spec = ChangeSpec(
        key=("tenant", "grant_id"), attributes=GRANTS.attributes, versioned=GRANTS.versioned
    )
    one = log(spark, event(1, "c", 0), event(2, "d", 2)).withColumn("tenant", F.lit("a"))
    two = log(spark, event(1, "c", 1), event(2, "u", 3, role=4)).withColumn("tenant", F.lit("b"))
    history = scd.access_history(one.unionByName(two), spec)
    assert history.filter("tenant = 'a'").count() == 1 and history.count() == 3
    state = scd.current_state(one.unionByName(two), spec).collect()
    assert [(r["tenant"], r["role_id"]) for r in state] == [("b", 4)]
