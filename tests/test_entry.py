import __spark_entry__ as entry


def test_every_sql_has_its_query_and_names_are_unique(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 80


def test_flagship_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["metric_name", "container_name", "timestamp", "value"] and df.count() > 0


def test_core_does_not_import_the_corpus_operators():
    import os
    import re

    root = os.path.dirname(entry.__file__)
    for folder, _, names in os.walk(os.path.join(root, "pulsegrid")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    assert not re.search(r"import.*\bllm\b|from.*\bllm\b", open(os.path.join(folder, name)).read())
