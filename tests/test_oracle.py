"""Every registered query against its DuckDB twin on the sf0.001 tables
(the driver's correctness gate, run locally)."""

import pytest

from barspark.plans.registry import REGISTRY
from paths import SF_SMALL
from oracle_harness import compare, duck

SQL_QUERIES = sorted(n for n, (_, sql) in REGISTRY.items() if sql is not None)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_query_matches_duckdb(spark, con, name):
    fn, sql = REGISTRY[name]
    got = fn(spark, SF_SMALL).toPandas()
    want = con.execute(sql).df()
    ok, msg = compare(got, want)
    assert ok, msg


def test_entry_contract(spark):
    import __spark_entry__ as e
    assert set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.count() > 0
    assert df.columns == ["symbol", "company_name", "sector", "total_trading_days", "min_price",
                          "max_price", "avg_close_price", "avg_daily_volume"]
