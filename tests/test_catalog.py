"""Every registered query with SQL agrees with DuckDB on the small tables."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402

from addrwatch.catalog import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for table in compare.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    verdict, _ = compare.compare(spark, con, name, sf)
    assert verdict.startswith("ok" if name in ORACLES else "rows only"), verdict
    assert "KINDS" not in verdict


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
