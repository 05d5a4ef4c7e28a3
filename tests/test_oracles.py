"""Every registered query against its SQL over the same tables."""

import pytest
from oracle import connect, differences, plan

import __spark_entry__ as contract
from trendstrata.catalogue import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, connection, name):
    result = QUERIES[name](spark, sf_dir)
    assert differences(result, connection, ORACLES[name]) == []
    # Neither pairs of all rows nor Python per row.
    steps = plan(result)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert operator not in steps


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0
