"""The registered queries, and those that SQL can express against it."""

import pytest

import __spark_entry__ as entry
from compare import differences
from grantchron.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert numbers == set(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    found = differences(QUERIES[name](spark, SF), SF, ORACLES[name])
    assert found is None, found
