"""Every registered query against plain SQL on the whole small tables."""

import pytest

import __spark_entry__ as entry
from compare import differences
from grantchron.plans.oracles import ORACLES
from grantchron.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, name):
    found = differences(QUERIES[name](spark, SF), SF, ORACLES[name])
    assert found is None, found


def test_entry(spark):
    assert entry.entry(spark).count() == 10
