"""Every query against its DuckDB oracle on the smallest tables; the register and its names."""

import decimal
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(n for n in __spark_entry__.oracle_sql())


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def value(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
        return "null"
    if isinstance(v, bool) or type(v).__name__ == "bool":
        return str(bool(v))
    if isinstance(v, (int, float, decimal.Decimal)) or hasattr(v, "dtype"):
        return f"{float(v):.6g}" if not hasattr(v, "isoformat") else str(v)
    return str(v)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_oracle(spark, oracle, name):
    got, want = __spark_entry__.queries()[name](spark, SMALL).toPandas(), oracle.execute(__spark_entry__.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda df: sorted(tuple(value(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))
    assert rows(got) == rows(want)


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert len(__spark_entry__.queries()) > 80


def test_entry_and_queries_without_oracle(spark):
    assert __spark_entry__.entry(spark).count() > 0
    for name in ("isolation_forest", "anomaly_flags_all", "composite_topk", "match_composite"):
        assert __spark_entry__.queries()[name](spark, SMALL).collect()


def test_filters_and_columns_reach_the_scan(spark):
    plan = __spark_entry__.queries()["filter_pushdown"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull" in plan and "l_comment" not in plan and os.path.exists(SMALL)
