"""Every query with SQL against DuckDB on the same tables; the others run and keep their columns."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as e
from fundlake.plans.driver import QUERIES
from fundlake.plans.oracle import ORACLE

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return c


def cell(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, pd.Timestamp):
        return str(x.date())
    if hasattr(x, "item"):
        x = x.item()
    return float(f"{x:.10g}") + 0.0 if isinstance(x, (int, float)) and not isinstance(x, bool) else x if isinstance(x, bool) else str(x)


def rows(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted((tuple(map(cell, r)) for r in df.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, sf, duck, name):
    assert rows(QUERIES[name](spark, sf).toPandas()) == rows(duck.sql(ORACLE[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    assert len(got) and len(set(got.columns)) == len(got.columns)


def test_entry(spark):
    assert e.entry(spark).count() == 10
    assert set(e.oracle_sql()) <= set(e.queries())
