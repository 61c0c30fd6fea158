import hashlib
import re

import pytest

from pulsegrid.llm import exact_dedup as exact_dedup_module
from pulsegrid.llm.exact_dedup import exact_dedup

SCHEMA = "doc_id long, text string, keep_id string"


def run(spark, rows, **more):
    return {r[0]: r for r in exact_dedup(spark.createDataFrame(rows, SCHEMA), **more).collect()}


def test_keeps_the_chosen_end_and_counts_groups(spark):
    rows = [(1, "a", "x"), (2, None, "x"), (3, "", "x"), (4, "a", "x"), (5, "a ", "x"), (6, "b" * 300_000, "x"), (7, "b" * 300_000, "x")]
    got = run(spark, rows, keep="largest")
    assert {k: (r.keep_id, r.group_size, r.kept) for k, r in got.items()} == {1: (4, 2, False), 2: (3, 2, False), 3: (3, 2, True), 4: (4, 2, True), 5: (5, 1, True), 6: (7, 2, False), 7: (7, 2, True)}
    assert got[2].text_sha256 == hashlib.sha256(b"").hexdigest()
    assert {k for k, r in run(spark, rows).items() if r.kept} == {1, 2, 5, 6}


@pytest.mark.parametrize("fan_in,n_runs", [(2, 5), (8, 64), (3, 1)])
def test_any_tree_gives_the_same(spark, fan_in, n_runs):
    df = spark.range(3000).selectExpr("id as doc_id", "cast(id % 7 as string) as text").repartition(9)
    got = exact_dedup(df, keep="largest", fan_in=fan_in, n_runs=n_runs).filter("kept").collect()
    assert sorted(r.doc_id for r in got) == list(range(2993, 3000))
    assert sum(r.group_size for r in got) == 3000


def test_null_ids_repeated_rows_and_no_rows(spark):
    got = exact_dedup(spark.createDataFrame([(None, "a", ""), (1, "a", ""), (1, "a", ""), (None, "z", "")], SCHEMA), keep="largest").collect()
    assert sorted((r.doc_id is not None, r.keep_id, r.group_size, r.kept) for r in got if r.keep_id) == [(False, 1, 3, False), (True, 1, 3, True), (True, 1, 3, True)]
    assert [(r.group_size, r.kept) for r in got if r.keep_id is None] == [(1, True)]
    assert run(spark, []) == {}
    with pytest.raises(ValueError):
        exact_dedup(spark.range(1))


def test_every_round_merges_sorted_runs(spark):
    docs = spark.range(100).selectExpr("id as doc_id", "cast(id % 7 as string) as text")
    runs = exact_dedup_module.digest_runs(docs, "doc_id", "text", "largest")
    merged = exact_dedup_module.merge_runs(runs, "largest")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    rounds = 2  # 64 runs, eight at a time
    assert "HashAggregate" not in plan
    assert len(re.findall(r"\bSort \[range", plan)) >= rounds + 2
    assert len(re.findall(r"\bSortAggregate\(", plan)) >= 2 * (rounds + 1)


def test_null_ids_and_the_smallest_id(spark):
    got = exact_dedup(spark.createDataFrame([(None, "a", ""), (4, "a", ""), (3, "a", "")], SCHEMA)).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {(None, 3, False), (4, 3, False), (3, 3, True)}
