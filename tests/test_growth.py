"""Queries on long series take more series when there are more users."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsegrid import queries as core

T0 = dt.datetime(2024, 1, 1)
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """400 hours of clicks and views of 40 and of 240 users; each hour has one event of each 40 users."""
    found = []
    for groups in (1, 6):
        rows = [(0, T0 + dt.timedelta(hours=h), 40 * g + h % 40, kind, float((h * h + 7 * g) % 101), '{"k": 1}') for g in range(groups) for h in range(400) for kind in ("click", "view")]
        path = str(tmp_path_factory.mktemp(f"users{groups}"))
        spark.createDataFrame(rows, EVENTS).withColumn("event_id", F.monotonically_increasing_id()).write.parquet(f"{path}/events.parquet")
        found.append(path)
    return found


NAMES = ["m1_arima_111", "m1_arima_110_growing", "m2_seasonal_arima", "m3_order_search", "m4_seasonal_trend", "m6_batch_score", "e4_multi_horizon_windows", "e5_prepare_training_data", "e10_m5_rolling_origin", "w4_limited_fill_growing", "w7_w9_windows_growing", "w12_temporal_split_growing", "a18_scores_growing"]


@pytest.mark.parametrize("name", NAMES)
def test_series_grow_with_the_users(spark, tables, name):
    few, many = (core.queries()[name](spark, path).select("metric_name", "container_name").distinct().count() for path in tables)
    assert few in (1, 2) and many == 6 * few


def test_pairs_of_series_grow_with_the_users(spark, tables):
    assert [core.queries()["a13_pearson_growing"](spark, path).count() for path in tables] == [1, 66]


def test_windows_have_the_operators_own_size(spark, tables):
    row = core.queries()["w7_w9_windows_growing"](spark, tables[0]).first()
    assert [len(row[c]) for c in ("x", "y_20", "y_60", "y_120")] == [240, 20, 60, 120]
    assert core.queries()["e10_m5_rolling_origin"](spark, tables[0]).select("horizon").distinct().count() == 3
