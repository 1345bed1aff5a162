"""Driver contract: entry() runs; every query equals its DuckDB oracle (sf0.001)."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from keyweave.plans.catalog import QUERIES
from tools.check_oracle import digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    return c


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "empId" in df.columns and len(df.columns) == 18


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(cols, orows)
