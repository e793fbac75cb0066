"""Registered queries against their DuckDB oracles on the smallest data set."""

import pytest

import oracle
from tidewake.bindings.registry import QUERIES
from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


# The text-corpus queries have tests of their own in tests/llm.
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = oracle.compare(queries()[name](spark, FOLDER), con, ORACLES[name])
    assert ok, note


def test_entry(spark):
    assert entry(spark).columns == ["ShipCode", "CabinCategoryCode", "CategoryRevenue", "TotalShipRevenue"]
