"""Known sizes of the derived logs at the smallest scale (FIXTURES 3 and 4)."""

import pytest
from pyspark.sql import functions as F

from grantchron.operators import batch, scd
from grantchron.plans.queries import QUERIES
from grantchron.plans.testdata import event_log

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark):
    return batch.stage(event_log(spark, SF))


def test_operations(staged):
    ops = {r["op"]: r["count"] for r in staged.groupBy("op").count().collect()}
    assert ops == {"r": 8, "c": 162, "u": 629, "d": 201}
    assert staged.filter("op = 'u' AND closes_access").count() == 160
    assert staged.filter("op IN ('r', 'c') AND revoked_at IS NOT NULL").count() == 42


def test_latest_per_key(staged):
    last = batch.latest_per_key(staged)
    got = last.agg(
        F.count("*"), F.count_if(F.col("op") == "d"), F.count_if("closes_access"), F.count_if("is_deleted")
    ).first()
    assert tuple(got) == (15, 3, 8, 0)


def test_gold_sizes(spark):
    log = event_log(spark, SF)
    assert scd.current_state(log).count() == 12
    history = scd.access_history(log)
    got = history.agg(
        F.count("*"), F.count_if("is_current"), F.count_if(F.col("is_deleted") & ~F.col("is_current"))
    ).first()
    assert tuple(got) == (639, 7, 132)
    assert QUERIES["scd2_latest_two_batches"](spark, SF).count() == 15
    assert QUERIES["asof_subject"](spark, SF).count() == 10


def test_late_and_tied_orders(spark):
    got = {r["cursor"]: (r["arrived"], r["skipped"]) for r in QUERIES["late_skipped"](spark, SF).collect()}
    assert got["capture_time"] == (750, 749) and got["arrival_position"] == (750, 0)
    assert QUERIES["tie_order"](spark, SF).count() == 1
