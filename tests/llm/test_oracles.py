"""Corpus queries that have SQL, against DuckDB on whole tables."""

from __future__ import annotations

import pytest

from reefcensus.llm.queries import ORACLE, QUERIES
from tests.oracle_check import compare, duck

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    r = compare(spark, duck(SF_DIR), name, QUERIES[name], ORACLE[name], SF_DIR)
    assert r["ok"], r
