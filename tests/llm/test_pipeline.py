import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_their_decisions(spark):
    from pulsegrid.llm import decontaminate, line_dedup, ngram_join
    from pulsegrid.llm.common import stored

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF))
        sizes.append(after.count())
        if name != "packing":
            assert after.columns == columns
            assert after.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0
        if name == "line dedup":
            assert after.filter("text = ''").count() <= docs.filter("text rlike '^\\s*$'").count()
            assert line_dedup.dedup_lines(after, max_edits=0).filter("n_removed > 0").count() == 0
        if name == "n-gram Jaccard join":
            assert ngram_join.near_duplicates(after).filter("component_id <> doc_id").count() == 0
        if name == "benchmark decontamination":
            bench = spark.read.parquet(f"{SF}/benchmark.parquet")
            assert decontaminate.contamination(decontaminate.find_overlaps(after, bench)).filter("contaminated").count() == 0
        if name == "packing":
            words = docs.selectExpr("sum(regexp_count(text, r'[^\\x20\\x09-\\x0D]+'))").first()[0]
            assert after.agg({"n_tokens": "sum"}).first()[0] == words
        docs = after
    assert sizes[1] < sizes[0]
    assert corpus_pipeline.run(spark, SF).count() == sizes[-1]


ODD = [
    (1, "one two three four five six seven eight\nsecond line", "en", "a", 51),
    (1, "one two three four five six seven eight\nsecond line", "en", "a", 51),
    (1, "another text of this id", "en", "a", 23),
    (None, "one two three four five six seven nine", "en", "b", 38),
    (None, "null id", None, None, 7),
    (2, None, "en", "a", None),
    (3, "", "en", "a", 0),
    (4, " \n\t\n", "en", "a", 4),
    (5, "one two three four five six seven eight\nsecond line\nthird", "en", "a", 57),
    (6, "very long " * 40_000, "en", "a", 400_000),
]


@pytest.mark.parametrize("rows", [ODD, [], ODD[5:6]])
def test_stages_on_odd_rows(spark, tmp_path, rows):
    """Nulls, blank and very long texts, repeated rows, clashing columns and no rows at all."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "7 as tag", "8 as stats", "9 as line", "1 as bucket", "2 as batch", "3 as _salt", "4 as n_words", "5 as score")
    folder = str(tmp_path)
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 0), (5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "benchmark words"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns, name
        assert after.count() <= len(rows), name
    assert corpus_pipeline.packed(spark, docs, folder).count() >= 0
    if rows is ODD:
        kept = corpus_pipeline.without_repeated_lines(spark, docs, folder).select("doc_id", "text").collect()
        # null ids come first; the repeated rows of id 1 share their verdicts
        assert sorted((r.doc_id or 0, r.text or "") for r in kept if r.doc_id != 6) == [(0, "null id"), (0, ODD[3][1]), (1, "another text of this id"), (1, "second line"), (1, "second line"), (2, ""), (3, ""), (4, " \n\t\n"), (5, "third")]
        one = corpus_pipeline.one_of_each_group(spark, docs, folder).select("doc_id", "text").collect()
        assert len(one) == len(ODD) - 2
