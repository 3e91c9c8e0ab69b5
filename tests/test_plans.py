"""Physical plans: shuffles, pruned columns, pushed filters, nothing row by row."""

import pytest

from grantchron.operators import batch, scd
from grantchron.plans.queries import QUERIES
from grantchron.plans.testdata import EVENT_LOG, event_log
from grantchron.sources import bronze

SF = "/root/testdata/sf0.001"
EAGER = {
    "merge_runs_in_store", "stream_merge_equals_batch", "idempotency_diff", "bronze_immutable",
    "prerevoked_two_merges", "seed_then_stream", "stream_new_checkpoint", "cursor_table",
    "routed_by_table", "completeness_gate", "named_history", "named_state", "named_active",
    "named_cursor", "schema_inventory", "access_change_two_batches",
    "dim_user_in_schema", "dim_role_in_schema", "history_with_user",
    "rewritten_without_change", "row_count_stored", "removal_kind_stored", "sql_as_of", "sql_ended_between",
    "snapshot_diff_stored", "business_assertions_stored",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_pairing_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert operator not in text


@pytest.mark.parametrize(
    "name", ["scd2_all_events", "scd1_all_events", "asof_subject", "event_trail", "removal_kind"]
)
def test_one_shuffle_by_key(spark, name):
    assert shuffles(QUERIES[name](spark, SF)) == 1


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bronze"))
    bronze.append_bronze(event_log(spark, SF), path)
    return bronze.read_bronze(spark, path, EVENT_LOG)


def test_latest_per_key_is_limited_before_the_shuffle(stored):
    text = plan(batch.latest_per_key(batch.stage(stored)))
    before = text.index("Exchange hashpartitioning")
    assert "Final" in text[:before] and "WindowGroupLimit" in text[before:]
    assert "Partial" in text[before:]


def test_history_reads_only_its_columns(stored):
    text = plan(scd.access_history(stored))
    assert text.count("Exchange hashpartitioning") == 1
    read = text.split("ReadSchema: ")[1]
    assert "__table" not in read and "__deleted" not in read


def test_small_batch_does_not_shuffle_the_stored_rows(spark, stored):
    state = scd.current_state(stored, mode="latest")
    events = batch.relate_events(batch.stage(stored), mode="latest")
    rows = spark.range(100).selectExpr(
        "id AS grant_id", "id AS user_id", "id AS role_id", "id AS resource_id",
        "timestamp_ntz'2026-01-01' AS granted_at", "timestamp_ntz'2026-01-01' AS revoked_at",
        "timestamp_ntz'2026-01-01' AS updated_at", "false AS is_deleted",
    )
    assert rows.schema.names == state.schema.names
    text = plan(scd.scd1_merge(rows, events, few_keys=True))
    stream_side = text.split("BroadcastExchange")[0]
    assert "LeftOuter, BuildRight" in stream_side and "Exchange hashpartitioning" not in stream_side


def test_a_batch_is_staged_in_one_pass(spark, stored, tmp_path, monkeypatch):
    from grantchron.plans import merge
    from grantchron.plans.store import GoldStore

    seen = []
    monkeypatch.setattr(
        type(stored.write), "parquet", lambda self, path, *a, **k: seen.append(plan(self._df))
    )
    with pytest.raises(Exception):  # nothing was written, so nothing can be read back
        merge._write_staged(GoldStore(spark, str(tmp_path)), stored, "b", "all", None).count()
    assert len(seen) == 1 and seen[0].count("FileScan") == 1


def test_a_range_of_ends_reads_its_days_only(spark, stored, tmp_path):
    from grantchron.operators import temporal
    from grantchron.plans.merge import run_merge
    from grantchron.plans.store import GoldStore

    store = GoldStore(spark, str(tmp_path / "gold"))
    run_merge(store, stored)
    for asked in (
        temporal.ended_between(store.history(), "2024-01-15 00:00:00", "2024-01-16 00:00:00"),
        temporal.ended_at(store.history(), "2024-01-15 00:00:00"),
        temporal.as_of(store.history(), "2024-01-15 00:00:00"),
    ):
        days = set(asked.select(_folder()).distinct().toPandas()["day"].dropna())
        text = plan(asked)
        closed = next(p for p in text.splitlines() if "NOT is_current" in p and "FileScan" in p)
        assert "cast(slot" in closed.split("PartitionFilters")[1].split("PushedFilters")[0]
        assert all(d >= "2024-01-15" for d in days)


def _folder():
    from pyspark.sql import functions as F

    return F.date_format("effective_end", "yyyy-MM-dd").alias("day")


def test_the_log_up_to_a_time_is_derived_alone(spark):
    from grantchron.operators import checks
    from grantchron.plans.queries import SPLIT_NS

    alone = event_log(spark, SF, before_ns=SPLIT_NS)
    assert checks.differences(alone, event_log(spark, SF).filter(f"__source_ts_ns < {SPLIT_NS}")).isEmpty()
    below = plan(alone).split("Exchange hashpartitioning")[1]
    assert f"< {SPLIT_NS}" in below  # later events are left out before the shuffle
