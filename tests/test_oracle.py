"""The driver's correctness gate, locally: every registered query against
its DuckDB oracle (row count, column names, order-insensitive value hash)."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from reefcensus.plans import driver_queries
from tests.oracle_check import compare, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(driver_queries.QUERIES))
def test_query_matches_oracle(spark, con, name):
    sql = entry.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle SQL"
    r = compare(spark, con, name, entry.queries()[name], sql, SF_DIR)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "l_linenumber",
                          "l_partkey", "l_suppkey", "l_quantity"]
