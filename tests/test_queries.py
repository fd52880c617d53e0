"""Every registered query against its SQL, bit for bit."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from barloom.oracles import ORACLES
from barloom.queries import REGISTRY
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    with connect(SF_DIR) as connection:
        yield connection


def test_every_query_has_an_oracle():
    assert REGISTRY.keys() == ORACLES.keys()
    assert REGISTRY.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, name):
    result = contract.queries()[name](spark, SF_DIR)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert operator not in plan
    assert differences(result, con, contract.oracle_sql()[name]) is None


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == contract.queries()["daily_metrics"](spark, SF_DIR).columns
    assert not result.isEmpty()
