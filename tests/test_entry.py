"""Driver contract: entry() runs, every query has a twin, and every query
agrees with its DuckDB twin on the sf0.001 tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["region", "storeno", "invoice_year", "invoice_month", "num_invoices",
                          "stock_count", "total_quantity", "total_sales"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) == set(E.ORACLE)
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.QUERIES) >= 30


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)
