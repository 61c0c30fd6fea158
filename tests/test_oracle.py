"""Each core query against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from pulsegrid import queries as core

SF = "/root/testdata/sf0.001"
QUERIES, SQL = core.queries(), core.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{SF}/{name}'")
    return con


def plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, (list, np.ndarray)):
        return tuple(plain(x) for x in v)
    if isinstance(v, (float, np.floating)):
        return round(float(v), 5)
    return str(pd.Timestamp(v)) if isinstance(v, (pd.Timestamp, np.datetime64)) else v


def rows(df):
    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, db, name):
    got, want = QUERIES[name](spark, SF).toPandas(), db.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
