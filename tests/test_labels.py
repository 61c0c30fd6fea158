import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import labels, scalars


@pytest.mark.parametrize(
    "text,name",
    [
        ("container=webapp,pod=test-webapp-12345,namespace=default", "webapp"),
        ("Container=Redis,pod=test", "Redis"),
        ("pod=webapp-abc123,namespace=default", "webapp"),
        ("pod=redis,namespace=default", "redis"),
        ("pod=test-db", "test"),
    ],
)
def test_container_names(spark, text, name):
    df = spark.createDataFrame([(text,)], "container_labels string")
    assert labels.with_container_name(df).first().container_name == name


@pytest.mark.parametrize("text,said", [("", "cannot be empty"), (None, "cannot be empty"), ("namespace=default,service=api", "Could not extract")])
def test_rows_without_a_name(spark, text, said):
    df = spark.createDataFrame([(text,), ("container=a",)], "container_labels string")
    with pytest.raises(Exception, match=said):
        labels.with_container_name(df).collect()
    assert labels.with_container_name(df, strict=False).filter("container_name is null").count() == 1
    assert labels.rejected_labels(df).count() == 1


def test_label_strings(spark):
    df = spark.createDataFrame([({"b": "2", "a": "1", "id": "/x", "job": "j", "instance": "i", "__name__": "n"},), ({},), (None,)], "l map<string,string>")
    assert [r[0] for r in df.select(labels.compress_labels(F.col("l"))).collect()] == ["a=1,b=2", "", ""]
    assert df.limit(1).select(labels.parse_labels(labels.compress_labels(F.col("l")))).first()[0] == {"a": "1", "b": "2"}


def test_selector_is_anchored(spark):
    rows = [({"id": "/kubepods/a", "container": "web", "namespace": "n1", "x": "v"},), ({"id": "/kubepods/a", "container": "webapp", "namespace": "n1", "x": "v"},), ({"id": "/other", "container": "web", "namespace": "n1", "x": "v"},)]
    df = spark.createDataFrame(rows, "l map<string,string>")
    assert df.filter(labels.label_selector(F.col("l"))).count() == 2
    assert df.filter(labels.label_selector(F.col("l"), container="web")).count() == 1
    assert df.filter(labels.label_selector(F.col("l"), container="web.*", namespace="n1|n2", x="v")).count() == 2
    assert df.filter(labels.label_selector(F.col("l"), x="w.*|u")).count() == 0


def test_selection_of_containers_and_metrics(spark):
    df = spark.createDataFrame([("web", "m"), ("webapp", "m"), ("db", "k")], "container_name string, metric_name string")
    pick = lambda *a, **b: sorted(r.container_name for r in labels.select_containers(df, *a, **b).collect())
    assert pick("web") == ["web"] and pick("WEB") == ["web", "webapp"] and pick("all") == pick("") == pick() == ["db", "web", "webapp"]
    assert pick("web", containers=["db", "none"]) == ["db"]
    for bad in ({"container": "zzz"}, {"containers": ["zzz"]}):
        with pytest.raises(ValueError):
            labels.select_containers(df, **bad)
    with pytest.raises(ValueError):
        labels.select_metric(df, "none")
    assert labels.parse_container_argument("a, b") == ["a", "b"] and labels.parse_container_argument("all") is None and labels.parse_container_argument("a") == "a"
    assert labels.metric_of("memory") == "container_memory_usage" and labels.metric_of("who knows") == labels.CPU
    assert labels.known_metrics(["memory", "zzz"]) == ["memory"]


def test_sample_values(spark):
    df = spark.createDataFrame([("NaN",), ("abc",), (None,), ("1.5",), ("+Inf",)], "v string")
    assert [r[0] for r in df.select(scalars.sample_value(F.col("v"))).collect()] == [0.0, 0.0, 0.0, 1.5, float("inf")]
    assert [r[0] for r in df.select(scalars.sample_value(F.col("v"), True)).collect()] == [None, None, None, 1.5, float("inf")]


def test_steps_and_minutes(spark):
    row = spark.range(1).select(scalars.steps_to_minutes(F.lit(23)).alias("m"), scalars.minutes_to_steps(F.lit(5)).alias("s")).first()
    assert (row.m, row.s) == (5, 20)
