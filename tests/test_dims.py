"""Dimensions and record-versus-access changes."""

import random

import pytest
from pyspark.sql import functions as F

import narrative as story
from grantchron.model import GRANT_DIMENSIONS
from grantchron.operators import batch, dims, scd
from grantchron.plans import catalog, dimensions
from grantchron.plans.merge import run_merge
from grantchron.plans.store import GoldStore
from test_semantics import day, event, log, ns


def test_latest_dimension_from_bronze(spark):
    users = dims.latest_dimension(
        story.bronze(spark), "user_id", ["user_name", "user_email"], ["__source_ts_ns", "event_id"]
    )
    assert {r["user_id"]: r["user_name"] for r in users.collect()} == story.USERS


def test_surrogate_keys(spark):
    dim = spark.range(0, 1000, 7).withColumnRenamed("id", "user_id").repartition(6)
    numbered = dims.dense_key(dim, "user_id", "user_sk").orderBy("user_id").collect()
    assert [r["user_sk"] for r in numbered] == list(range(1, len(numbered) + 1))
    hashed = dims.hashed_key(dim, "user_id", "user_sk")
    assert hashed.select("user_sk").distinct().count() == len(numbered)
    known = dims.dense_key(dim.filter("user_id < 500"), "user_id", "user_sk")
    grown = dims.with_new_keys(known, dim, "user_id", "user_sk")
    assert grown.join(known, ["user_id", "user_sk"]).count() == known.count()
    assert sorted(r["user_sk"] for r in grown.collect()) == list(range(1, len(numbered) + 1))


def test_attribute_versions(spark):
    rows = [(1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (1, 4, None), (2, 1, "a"), (1, 5, None), (1, 6, "a")]
    df = spark.createDataFrame(rows, "role_id bigint, at bigint, category string")
    got = dims.attribute_history(df, "role_id", ["at"], ["category"], "at")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(
        [(1, "a", 1, 3, False), (1, "b", 3, 4, False), (1, None, 4, 6, False),
         (1, "a", 6, None, True), (2, "a", 1, None, True)], key=repr,
    )


def test_record_change_is_not_access_change(spark):
    bronze = log(
        spark, event(1, "c", 0), event(2, "u", 1, granted=day(-3)), event(3, "u", 2, role=2),
        event(4, "u", 3, role=2, granted=day(2)), event(5, "d", 4), event(6, "d", 5),
    )
    staged = batch.stage(bronze)
    got = {r["event_id"]: (r["record_changed"], r["access_changed"])
           for r in dims.classify_changes(staged).collect()}
    assert got == {1: (True, True), 2: (True, False), 3: (True, True), 4: (False, False),
                   5: (True, True), 6: (False, False)}
    changed = dims.changed_only(staged, ["grant_id"], ["__source_ts_ns", "event_id"], ["closes_access", "role_id"])
    history = scd.opened_periods(batch.relate_events(changed))
    ends = sorted((r["effective_start"], r["effective_end"]) for r in history.collect())
    assert ends == [(day(0), day(2)), (day(2), day(4))]


def _grants(spark, folder, **options):
    return GoldStore(spark, folder, buckets=3, dimensions=GRANT_DIMENSIONS, **options)


def _versions(store, dim):
    return sorted((tuple(r) for r in store.dimension(dim).collect()), key=repr)


def test_dimensions_of_the_story(spark, folder):
    store = _grants(spark, folder + "/gold")
    for last in (4, 6, 10):
        run_merge(store, story.bronze(spark, range(1, last)))
    user, role, resource = GRANT_DIMENSIONS
    users = store.dimension(user).collect()
    assert {r["user_id"]: r["user_name"] for r in users} == story.USERS
    assert all(r["is_current"] and r["effective_end"] is None for r in users)
    assert sorted(r["user_sk"] for r in users) == [1, 2, 3, 4, 5]
    assert {r["user_id"]: r["user_sk"] for r in users}[101] == 1  # of the first merge
    assert store.dimension(role).count() == 3 and store.dimension(resource).count() == 6
    found = dimensions.described(store.history(), store.dimension(user), user).collect()
    assert len(found) == 6 and all(r["user_name"] == story.USERS[r["user_id"]] for r in found)


def test_loads_in_any_split_equal_one_pass(spark, folder):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        user = rng.choice([1, 1, 1, 2, 3, 40, 50, None])
        name, mail = rng.choice(["a", "b", None]), rng.choice(["x", "x", "x", "y"])
        op = "d" if user is None else rng.choice("ru")
        when = day(rng.randint(0, 30)) if op != "d" else None
        rows.append((i, i % 9, user, name, mail, None, None, when, when, False, op, ns(i)))
    columns = "event_id long, grant_id long, user_id long, user_name string, user_email string, role_id long, " \
        "resource_id long, granted_at timestamp_ntz, updated_at timestamp_ntz, is_deleted boolean, " \
        "__op string, __source_ts_ns long"  # fmt: skip
    log = spark.createDataFrame(rows, columns).withColumn("revoked_at", F.lit(None).cast("timestamp_ntz"))
    user = GRANT_DIMENSIONS[0]
    told = log.filter("user_id IS NOT NULL")
    expected = dims.attribute_history(
        told, "user_id", ["__source_ts_ns", "event_id"], ["user_name", "user_email"], "updated_at"
    )
    wanted = sorted((tuple(r) for r in expected.collect()), key=repr)
    keys = []
    for n, (cuts, hot) in enumerate((([300], None), ([40, 41, 200, 300], None), ([150, 300], 5))):
        store = GoldStore(spark, f"{folder}/gold{n}", buckets=3, dimensions=(user,))
        for cut in cuts:
            run_merge(store, log.filter(F.col("event_id") < cut), hot_limit=hot)
        found = _versions(store, user)
        assert sorted((f[1:] for f in found), key=repr) == wanted
        by_key = {f[1]: f[0] for f in found}
        assert sorted(by_key.values()) == [1, 2, 3, 4, 5] and len({f[:2] for f in found}) == 5
        keys.append(store.latest().dims["dim_user"]["keys"])
        version = store.latest()
        assert run_merge(store, log, hot_limit=hot) == version  # nothing new
    assert keys == [5, 5, 5]
    store.vacuum(keep_versions=1)
    assert _versions(store, user) == found


def test_a_busy_key_is_thinned_before_it_is_put_in_order(spark, folder, monkeypatch):
    """A user with an event a minute over ten hours, told otherwise twice within one of them."""
    start, minute = ns(0), 60 * 10**9
    names = ["b" if 330 <= i < 335 else None if i >= 500 else "a" for i in range(600)]
    rows = [
        (i, i % 50, 7 if i % 60 else 8, name, "x", 1, 1, day(0), day(i), False, "r", start + i * minute)
        for i, name in enumerate(names)
    ]
    columns = "event_id long, grant_id long, user_id long, user_name string, user_email string, role_id long, " \
        "resource_id long, granted_at timestamp_ntz, updated_at timestamp_ntz, is_deleted boolean, " \
        "__op string, __source_ts_ns long"  # fmt: skip
    log = spark.createDataFrame(rows, columns).withColumn("revoked_at", F.lit(None).cast("timestamp_ntz"))
    user, seen, relate = GRANT_DIMENSIONS[0], [], dimensions.relate_events

    def counted(told, *args, **kwargs):
        seen.append(told.count())
        return relate(told, *args, **kwargs)

    monkeypatch.setattr(dimensions, "relate_events", counted)
    found = []
    for n, hot_limit in enumerate((10**9, 100, 1000)):
        store = GoldStore(spark, f"{folder}/gold{n}", buckets=3, dimensions=(user,))
        for cut in (200, 600):
            run_merge(store, log.filter(F.col("event_id") < cut), hot_limit=hot_limit)
        found.append(_versions(store, user))
    assert seen[:2] == [200, 400] and max(seen[2:]) < 200
    assert found[0] == found[1] == found[2]
    of_seven = sorted((v for v in found[0] if v[1] == 7), key=lambda v: v[4])
    assert [(v[2], v[4]) for v in of_seven] == [("a", day(1)), ("b", day(330)), ("a", day(335)), (None, day(500))]


def test_a_batch_s_changes_are_written_before_they_are_related(spark, folder, monkeypatch):
    """Or else each use of them puts the whole batch in order again."""
    store, related, plans = _grants(spark, folder + "/gold"), dimensions.access_changes, []

    def planned(rows, *args, **kwargs):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return related(rows, *args, **kwargs)

    monkeypatch.setattr(dimensions, "access_changes", planned)
    run_merge(store, story.bronze(spark))
    assert len(plans) == len(store.dimensions) and not any("Window" in p for p in plans)


def test_dimension_and_facts_are_one_commit(spark, folder, monkeypatch):
    store = _grants(spark, folder + "/gold")
    run_merge(store, story.bronze(spark, range(1, 4)))
    before, version = _versions(store, GRANT_DIMENSIONS[0]), store.latest()

    def fail(self, dim, rows, batch):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(GoldStore, "write_dimension", fail)
        with pytest.raises(RuntimeError, match="lost"):
            run_merge(store, story.bronze(spark))
    assert store.latest() == version and _versions(store, GRANT_DIMENSIONS[0]) == before
    run_merge(store, story.bronze(spark))
    assert store.dimension(GRANT_DIMENSIONS[0]).count() == 5 and story.history_rows(store.history()) == story.HISTORY


def test_a_batch_that_changes_no_attribute_writes_no_version(spark, folder):
    store = _grants(spark, folder + "/gold")
    run_merge(store, story.bronze(spark, range(1, 4)))
    before = store.latest().dims
    run_merge(store, story.bronze(spark, range(1, 5)))  # a revocation
    assert store.latest().dims == before


def test_dimensions_by_name(spark, folder):
    store = _grants(spark, folder + "/gold")
    catalog.create_star_schema(spark, "iam_dims")
    try:
        catalog.publish_tables(store, "iam_dims")
        assert spark.table("iam_dims.dim_user").isEmpty()
        run_merge(store, story.bronze(spark))
        catalog.publish_tables(store, "iam_dims")
        asked = spark.newSession().sql(
            "SELECT u.user_name, h.effective_start FROM iam_dims.fact_access_grant_history h "
            "JOIN iam_dims.dim_user u ON u.user_id = h.user_id AND u.effective_start <= h.effective_start "
            "AND (u.effective_end IS NULL OR u.effective_end > h.effective_start)"
        )
        assert asked.count() == 6
    finally:
        catalog.drop_star_schema(spark, "iam_dims")
