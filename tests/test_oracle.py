"""Every registered query against its SQL on DuckDB, on the smallest bundled data."""

from __future__ import annotations

import os

import pytest
from oracle import difference, duckdb_rows, open_duckdb, spark_rows

import __spark_entry__ as entry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return open_duckdb(DATA)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="bundled data not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = spark_rows(QUERIES[name](spark, DATA))
    if name in CHECKS:
        assert difference(result, duckdb_rows(duck, CHECKS[name])) is None


@pytest.mark.skipif(not os.path.isdir(entry.SMOKE_DIR), reason="bundled data not present")
def test_entry(spark):
    result = entry.entry(spark)
    assert "target_delay_4_stops_sec" in result.columns and result.count() > 0
