"""Random logs against a plain model that merges one event at a time."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from grantchron.model import ACCESS
from grantchron.operators import batch, dims, ordered as ordered_runs, scd, temporal
from grantchron.operators.ordered import OrderedRuns
from grantchron.session import materialize
from test_semantics import COLUMNS, T0, log, ns

KEYS, LOGS = 5, 120
HISTORY = "grant_id user_id role_id resource_id granted_at revoked_at effective_start " \
    "effective_end is_current is_deleted".split()  # fmt: skip
STATE = "grant_id user_id role_id resource_id granted_at revoked_at updated_at is_deleted".split()


def random_log(rng, first_key):
    """Re-grants, repeated deletes, deletes of unknown keys, business times that run back."""
    events = []
    for i in range(rng.randint(1, 30)):
        key, op = first_key + rng.randrange(KEYS), rng.choice("ccuuuudr")
        if op == "d":
            events.append((i, key, *[None] * 7, "d", ns(i // 2)))
            continue
        when = T0 + timedelta(days=rng.randint(0, 20))
        revoked = when if rng.random() < 0.3 else None
        events.append(
            (i, key, rng.randint(1, 9), rng.randint(1, 3), rng.randint(501, 503),
             T0 + timedelta(days=rng.randint(-9, 9)), revoked, when, rng.random() < 0.2, op, ns(i // 2))
        )
    return events


def step(state, history, event):
    """The merge statements for a batch of one event."""
    _, key, user, role, resource, granted, revoked, updated, soft, op, captured = event
    when = datetime(1970, 1, 1) + timedelta(microseconds=captured // 1000) if op == "d" else updated
    closes = op == "d" or (op == "u" and revoked is not None)
    if op == "d":
        state.pop(key, None)
    elif key in state:
        state[key][2:4] = [role, resource]
        state[key][5:] = [revoked, updated, soft]
    else:
        state[key] = [key, user, role, resource, granted, revoked, updated, soft]
    for row in history:
        if row[0] == key and row[8]:
            row[7:] = [when, False, op == "d"]
    if not closes:
        history.append([key, user, role, resource, granted, revoked, when, None, True, soft])


def ordered(rows):
    return sorted([tuple(r) for r in rows], key=repr)


@pytest.fixture(scope="module")
def logs():
    rng = random.Random(5)
    return [random_log(rng, KEYS * n) for n in range(LOGS)]


@pytest.fixture(scope="module")
def expected(logs):
    states, histories = [], []
    for events in logs:
        state, history = {}, []
        for e in sorted(events, key=lambda e: (e[10], e[0])):
            step(state, history, e)
        states += state.values()
        histories += history
    return ordered(states), ordered(histories)


@pytest.mark.parametrize("hot_limit", [None, 3])
def test_one_pass_equals_event_by_event(spark, logs, expected, hot_limit):
    bronze = log(spark, *[e for events in logs for e in events])
    state = scd.current_state(bronze, hot_limit=hot_limit)
    history = scd.access_history(bronze, hot_limit=hot_limit)
    assert ordered(state.select(STATE).collect()) == expected[0]
    assert ordered(history.select(HISTORY).collect()) == expected[1]


@pytest.mark.parametrize("seed, few_keys", [(1, False), (2, True)])
def test_any_split_gives_the_same(spark, logs, expected, seed, few_keys):
    """Each log is cut at random places of its own; the parts are merged one after another."""
    rng = random.Random(seed)
    parts = [[], [], []]
    for events in logs:
        events = sorted(events, key=lambda e: (e[10], e[0]))
        a, b = sorted(rng.randint(0, len(events)) for _ in range(2))
        for part, chosen in zip(parts, (events[:a], events[a:b], events[b:])):
            part += chosen
    state, closed, open_rows = None, None, None
    for part in parts:
        events = batch.relate_events(batch.stage(log(spark, *part)))
        state = scd.scd1_merge(state, events, few_keys=few_keys)
        merged = scd.scd2_merge(open_rows, events, few_keys=few_keys)
        ended = merged.filter("NOT is_current")
        closed = ended if closed is None else closed.unionByName(ended)
        open_rows = merged.filter("is_current")
    assert ordered(state.select(STATE).collect()) == expected[0]
    assert ordered(closed.unionByName(open_rows).select(HISTORY).collect()) == expected[1]


@pytest.mark.parametrize("hot_limit", [None, 1, 7])
@pytest.mark.parametrize("clean", [True, False])
def test_batched_as_of_equals_brute_force(spark, clean, hot_limit):
    rng = random.Random(11)
    periods = []
    for i in range(160):
        start = T0 + timedelta(hours=rng.randint(0, 400), microseconds=rng.randint(0, 3))
        length = timedelta(hours=rng.choice([-3, 0, 0, 1, 30, 200]), microseconds=rng.randint(0, 3))
        periods.append((rng.choice([1, 2, None]), i, start, None if rng.random() < 0.2 else start + length))
    far = datetime(9999, 12, 31, 23, 59, 59, 999999)
    periods += [(1, 900, T0, far), (2, 901, datetime(1, 1, 1), T0 + timedelta(hours=3))]
    if clean:  # periods of one key follow each other
        by_key = {}
        for key, i, start, _ in sorted(periods, key=lambda p: p[2]):
            by_key.setdefault(key, []).append((key, i, start))
        periods = [
            (*p, (later[2] if later else None))
            for chain in by_key.values()
            for p, later in zip(chain, chain[1:] + [None])
        ]
    probes = [
        (n, rng.choice([1, 2, 3, None]),
         None if rng.random() < 0.1 else T0 + timedelta(hours=rng.randint(-5, 420), microseconds=rng.randint(0, 3)))
        for n in range(80)
    ] + [(100 + n, p[0], p[2]) for n, p in enumerate(periods)]
    times = (far, datetime(2150, 1, 1), datetime(1, 1, 1), datetime(1850, 1, 1))
    probes += [(900 + n, key, t) for n, t in enumerate(times) for key in (1, 2)]
    history = spark.createDataFrame(
        periods, "user_id bigint, period bigint, effective_start timestamp_ntz, effective_end timestamp_ntz"
    )
    asked = spark.createDataFrame(probes, "probe bigint, user_id bigint, t timestamp_ntz")
    found = temporal.as_of_probes(history, asked, ["user_id"], "t", tie=["period"], hot_limit=hot_limit)
    wanted = sorted(
        (n, p[1]) for n, key, t in probes for p in periods
        if t and key is not None and key == p[0] and p[2] <= t and (p[3] is None or p[3] > t)
    )
    assert sorted((r["probe"], r["period"]) for r in found.collect()) == wanted


@pytest.mark.parametrize("hot_limit", [1, 10, 1000])
def test_values_before_a_row_in_ranges_equal_a_loop(spark, hot_limit):
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, 2, None]), i, rng.choice([None, None, i])) for i in range(300)]
    df = spark.createDataFrame(rows, "k bigint, i bigint, sparse bigint")
    found = OrderedRuns(df, ["k"], ["i"], hot_limit).add(before={"b": F.col("sparse")}).rows()
    known, wanted = {}, {}
    for k, i, sparse in rows:
        wanted[i] = known.get(k)
        known[k] = known.get(k) if sparse is None else sparse
    assert {r["i"]: r["b"] for r in found.collect()} == wanted


def test_probes_and_periods_are_sorted_once(spark, monkeypatch):
    plans = []

    def planned(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, label)

    monkeypatch.setattr(temporal, "materialize", planned)
    history = spark.createDataFrame(
        [(1, 5, T0, None)], "user_id bigint, period bigint, effective_start timestamp_ntz, effective_end timestamp_ntz"
    )
    asked = spark.createDataFrame([(9, 1, T0)], "probe bigint, user_id bigint, t timestamp_ntz")
    assert temporal.as_of_probes(history, asked, ["user_id"], "t").count() == 1
    assert len(plans) == 1 and plans[0].count("Sort [") == 1


@pytest.mark.parametrize("hot_limit", [1, 10, 1000])
def test_ordered_runs_in_ranges_equal_a_plain_window(spark, hot_limit):
    """One key holds most rows, one key is NULL, and values are NULL here and there."""
    rng = random.Random(3)
    rows = [
        (rng.choice([1, 1, 1, 1, 2, 3, None]), i, rng.choice([None, None, i]), rng.choice([None, "a", "b"]))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "k bigint, i bigint, sparse bigint, s string")

    def neighbours(limit):
        value = F.struct("sparse", "s")
        runs = OrderedRuns(df, ["k"], ["i"], limit).add(
            prev={"p": value}, next={"n": value},
            last={"l": F.col("sparse")}, coming={"c": F.col("sparse")},
        )
        runs = runs.add(prev={"pp": F.struct("p")}, last={"ll": F.when(F.col("s") == "a", F.col("i"))})
        return sorted(map(repr, runs.rows().collect()))

    assert neighbours(hot_limit) == neighbours(10**9)


def test_number_of_ranges_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(ordered_runs, "MAX_RANGES", 10)
    df = spark.range(1000).selectExpr("id % 40 % 7 AS k", "id")  # six keys of 150 rows, one of 100
    # 1000 rows in 10 ranges: a key of 200 rows or fewer can stay whole.
    assert ordered_runs.find_hot_keys(df, ["k"], 1) is None
    skewed = df.selectExpr("if(id % 3 = 0, 0, id) AS k", "id")
    hot = ordered_runs.find_hot_keys(skewed, ["k"], 1)
    assert (hot.n_keys, hot.n_rows) == (1, 334) and hot.n_ranges <= 10


def test_columns_of_random_logs_are_those_of_the_schema():
    assert len(random_log(random.Random(1), 0)[0]) == len(COLUMNS.split(","))


@pytest.mark.parametrize("seed, few_keys, hot_limit", [(1, False, None), (2, True, None), (3, True, 4)])
def test_access_changes_do_not_depend_on_the_split(spark, logs, seed, few_keys, hot_limit):
    whole = [e for events in logs for e in events]
    staged = batch.stage(log(spark, *whole))
    changed = dims.changed_only(staged, ["grant_id"], ["__source_ts_ns", "event_id"], ["closes_access", *ACCESS])
    expected = ordered(scd.opened_periods(batch.relate_events(changed)).select(HISTORY).collect())
    rng = random.Random(seed)
    parts = [[], [], [], []]
    for events in logs:
        events = sorted(events, key=lambda e: (e[10], e[0]))
        cuts = [0, *sorted(rng.randint(0, len(events)) for _ in range(3)), len(events)]
        for part, low, high in zip(parts, cuts, cuts[1:]):
            part += events[low:high]
    closed, open_rows = None, None
    for part in parts:
        events = batch.relate_events(batch.stage(log(spark, *part)), hot_limit=hot_limit, tracked=ACCESS)
        events = scd.access_changes(events, open_rows, few_keys=few_keys, hot_limit=hot_limit)
        # Written, as in a store: plans of four merges in one would grow.
        merged = materialize(scd.scd2_merge(open_rows, events, few_keys=few_keys), "merged")
        ended = merged.filter("NOT is_current")
        closed = ended if closed is None else closed.unionByName(ended)
        open_rows = merged.filter("is_current")
    assert ordered(closed.unionByName(open_rows).select(HISTORY).collect()) == expected


def test_access_must_be_in_the_history(spark, logs):
    events = batch.relate_events(batch.stage(log(spark, *logs[0])), tracked=("updated_at",))
    with pytest.raises(ValueError, match="updated_at"):
        scd.access_changes(events, None, access=("updated_at",))
