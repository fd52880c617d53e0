"""Corpus queries that SQL can express, against DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from barloom.llm.oracles import LLM_ORACLES
from tests.oracle import connect, differences


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, name, scale):
    sf_dir = f"/root/testdata/{scale}"
    assert contract.oracle_sql()[name] == LLM_ORACLES[name]
    with connect(sf_dir) as con:
        assert differences(contract.queries()[name](spark, sf_dir), con, LLM_ORACLES[name]) is None
