import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import explore, quantiles, scale

SHARES = (0.0, 0.25, 0.5, 0.75, 0.95, 1.0)


def table(spark):
    rng = np.random.default_rng(0)
    rows = [("normal", float(v), 1) for v in rng.normal(size=900)]
    rows += [("heavy", float(v), int(w)) for v, w in zip(np.exp(rng.normal(scale=80, size=700)), rng.integers(0, 5, 700), strict=True)]
    rows += [("hot", 7.0, 2)] * 500 + [("hot", float(v), 1) for v in rng.integers(0, 15, 400)]
    rows += [("one", 3.0, 1), (None, 1.0, 3), (None, -2.0, 1), ("null", None, 1), ("two", -0.5, 1), ("two", 0.25, 0)]
    return spark.createDataFrame(rows, "k string, v double, w int")


def got(df):
    return {r[0]: r.q for r in df.collect()}


@pytest.mark.parametrize("most,cuts", [(100_000, 31), (50, 5), (1, 3), (8, 31)])
@pytest.mark.parametrize("weight", [None, "w"])
def test_equals_percentile_at_every_size(spark, most, cuts, weight):
    df = table(spark)
    share = F.array(*[F.lit(s) for s in SHARES])
    exact = F.percentile("v", share) if weight is None else F.percentile("v", share, F.col("w"))
    want = got(df.groupBy("k").agg(exact.alias("q")).filter("q is not null"))
    found = got(quantiles.quantiles(df, "v", SHARES, ("k",), weight, most, cuts))
    assert found == want


def test_whole_table_and_empty_table(spark):
    df = table(spark)
    want = df.agg(F.percentile("v", F.array(F.lit(0.5), F.lit(0.1))).alias("q")).first().q
    assert quantiles.quantiles(df, "v", (0.5, 0.1), most=40, cuts=4).first().q == want
    assert quantiles.quantiles(df.limit(0), "v", (0.5,)).count() == 0


def test_no_plan_keeps_all_values_of_a_group(spark):
    df = table(spark)
    for out in (explore.describe(df, "v", ("k",)), scale.fit_scaler(df, ["v"], "robust"), explore.cluster_statistics(df.selectExpr("k AS metric_name", "current_timestamp() AS timestamp", "v AS value"), wide=True)):
        assert "percentile(" not in out._jdf.queryExecution().toString()
