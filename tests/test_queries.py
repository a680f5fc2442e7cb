"""Every registered query of the graph engine against its SQL at the smallest size."""

import os

import duckdb
import pandas as pd
import pytest

from atlasmill import registry

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    for t in os.listdir(DIR):
        c.sql(f"CREATE VIEW {t[:-8]} AS SELECT * FROM '{DIR}/{t}'")
    return c


def plain(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
        return ""
    return f"{float(x):.6g}" if isinstance(x, (int, float)) or hasattr(x, "dtype") else str(x)


def rows(df):
    return sorted(tuple(plain(v) for v in r) for r in df[sorted(df.columns)].values.tolist())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, sql, name):
    got = registry.queries()[name](spark, DIR).toPandas()
    want = sql.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
