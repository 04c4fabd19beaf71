"""Driver contract: entry smoke, registry/oracle keys, and Spark == DuckDB per query."""

import duckdb
import pytest

import __spark_entry__ as E
from brightlake.oracle import SQL
from brightlake.registry import QUERIES
from brightlake.sources.tables import DRIVER_TABLES
from tools.check_oracle import canon

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {"churn_scores", "ltv_scores", "trained_churn_risk"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["date", "total_orders", "total_revenue", "avg_order",
                          "unique_customers", "top_category"]


def test_every_query_has_oracle_or_is_rows_only():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert canon(rows, cols) == canon(orows, ocols)
