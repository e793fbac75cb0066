"""Queries that SQL can express, against DuckDB."""

import duckdb
import pytest

import oracle
from tidewake.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    ok, note = oracle.compare(QUERIES[name](spark, FOLDER), con, ORACLES[name])
    assert ok, note
