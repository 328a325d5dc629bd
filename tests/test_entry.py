"""Driver contract: entry() runs; queries() and oracle_sql() agree (sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SMOKE = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "avg_ticket" in df.columns


def test_every_query_has_oracle_or_is_listed():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    from retailflow.plans.queries import QUERIES

    assert set(QUERIES) <= set(o)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMOKE, t + '.parquet')}')")
    return c


def _norm(v):
    return repr(v) if isinstance(v, float) else (v.isoformat() if hasattr(v, "isoformat") else v)


@pytest.mark.parametrize("name", ["fact_daily_sales_by_store", "silver_products", "average_ticket",
                                  "abc_products", "dim_calendar", "gold_key_report", "synthetic_sales",
                                  "average_ticket_from_sets", "fact_monthly_sales_by_category_spread", "reloaded_fact_by_store",
                                  "replaced_sales", "appended_sales", "refreshed_fact_by_store", "refreshed_key_report",
                                  "orders_by_revenue_weight", "part_key_series", "load_audit"])
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SMOKE)
    cols = sorted(df.columns)
    a = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=str)
    res = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    b = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=str)
    assert a == b
