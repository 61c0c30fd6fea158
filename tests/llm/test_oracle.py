"""The corpus queries against their SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from pulsegrid.llm import queries as llm

SF = "/root/testdata/sf0.001"
QUERIES, SQL = llm.queries(), llm.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SF}/{file}'")
    want = con.execute(SQL[name])
    columns = sorted(d[0] for d in want.description)
    expect = sorted((tuple(r) for r in want.df()[columns].astype(object).itertuples(index=False)), key=repr)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted((tuple(r) for r in got.toPandas()[columns].astype(object).itertuples(index=False)), key=repr) == expect


def test_queries_without_sql_are_those_that_sql_cannot_say():
    assert sorted(set(QUERIES) - set(SQL)) == ["op12_token_files", "op5_quality", "op9_packing"]
