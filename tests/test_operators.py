import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.labels import CPU
from pulsegrid.operators import clean, correlate, evaluate, explore, features, forecast, rates, scale, split, vocabulary, windows
from pulsegrid.plans import pipelines

T0 = dt.datetime(2024, 1, 1)
SAMPLES = "metric_name string, container_name string, timestamp timestamp_ntz, value double"


def series(spark, values, container="a", metric="m", step=15, start=T0):
    rows = [(metric, container, start + dt.timedelta(seconds=step * i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SAMPLES)


def many(spark, n=2000):
    parts = [series(spark, 50 + 20 * np.sin(np.linspace(0, 10, n)), c, start=T0) for c in ("webapp", "database", "redis")]
    return parts[0].union(parts[1]).union(parts[2])


def test_long_gaps_keep_a_null_middle(spark):
    rows = [("m", "a", T0, 1.0), ("m", "a", T0 + dt.timedelta(seconds=15 * 9), 5.0), ("m", "a", T0 + dt.timedelta(seconds=15 * 9 + 4), float("nan"))]
    grid = clean.regular_grid(spark.createDataFrame(rows, SAMPLES)).orderBy("timestamp")
    assert [r.value for r in grid.collect()] == [1, 1, 1, 1, None, None, 5, 5, 5, 5]
    assert clean.drop_incomplete(grid).count() == 8
    full = clean.fill_unlimited(clean.fill_grid(clean.resample(spark.createDataFrame(rows, SAMPLES)))).orderBy("timestamp")
    assert [r.value for r in full.collect()] == [1.0] * 9 + [5.0]


@pytest.mark.parametrize("step", [15, 7, 60])
def test_resampling_matches_pandas(spark, step):
    rng = np.random.default_rng(1)
    at = np.sort(rng.uniform(80_000, 90_000, 300))
    pdf = pd.DataFrame({"timestamp": pd.Timestamp(T0) + pd.to_timedelta(at, unit="s").floor("us"), "value": rng.normal(size=300)})
    want = pdf.set_index("timestamp")["value"].resample(f"{step}s").mean().ffill(limit=3).bfill(limit=3)
    df = spark.createDataFrame(pdf).select(F.lit("m").alias("metric_name"), F.lit("a").alias("container_name"), F.col("timestamp").cast("timestamp_ntz"), "value")
    got = clean.regular_grid(df, step).toPandas().sort_values("timestamp").set_index("timestamp")["value"]
    assert list(got.index) == list(want.index)
    assert np.allclose(got.to_numpy(float), want.to_numpy(), equal_nan=True)


def test_units(spark):
    cpu = clean.convert_units(series(spark, [0.3, 0.9, -1.0], metric=CPU)).orderBy("timestamp").collect()
    assert [r.value for r in cpu] == [30.0, 90.0, 0.0]
    assert [r.value for r in clean.convert_units(series(spark, [1.5, 300], metric=CPU)).orderBy("timestamp").collect()] == [1.5, 100.0]
    assert clean.convert_units(series(spark, [2**20 * 3], metric="container_memory_usage")).first().value == 3.0
    assert clean.convert_units(series(spark, [2**20], metric="container_network_receive_rate")).first().value == 8.0
    assert clean.convert_units(series(spark, [-4], metric="container_fs_reads_rate")).first().value == 0.0


def test_outliers_are_clipped_per_series(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.normal(50, 5, 95), [200, 250, 300, 400, 500]])
    got = clean.clip_outliers(series(spark, values).union(series(spark, [7, 7, 7], "b")), 2.0).toPandas()
    a = got[got.container_name == "a"]["value"]
    assert np.isclose(a.max(), values.mean() + 2 * values.std(ddof=1)) and a.min() >= 0
    assert set(got[got.container_name == "b"]["value"]) == {7.0}
    df = series(spark, values)
    assert clean.clip_outliers(df, None) is df


def test_centred_bands_match_pandas(spark):
    s = pd.Series(np.arange(30.0) ** 1.5)
    want = s.rolling(20, center=True).mean()
    df = series(spark, s).drop("container_name")
    got = explore.bands(df).orderBy("timestamp").toPandas()
    assert np.allclose(got["band_mean"].to_numpy(float), want.to_numpy(), equal_nan=True)
    assert not got["spike"].isna().any()


def test_feature_columns_and_rows(spark):
    table = features.add_features(series(spark, np.sin(np.arange(1000.0))))
    assert len(features.feature_columns(table)) == 27 and table.count() == 976
    plain = features.add_features(series(spark, range(50)), with_calendar=False, with_lags=False, with_rolling=False)
    assert features.feature_columns(plain) == ["value"] and plain.count() == 50


@pytest.mark.parametrize("window,horizons,stride,each", [(100, (20, 60), 10, 185), (50, (10,), 25, 78), (240, (20, 60, 120), 4, 411)])
def test_window_counts_and_boundaries(spark, window, horizons, stride, each):
    df = many(spark)
    counts = {r.container_name: r["count"] for r in windows.window_index(df, window, horizons, stride).groupBy("container_name").count().collect()}
    assert counts == dict.fromkeys(("webapp", "database", "redis"), each)
    if each == 78:
        plain = windows.sliding_windows(df, window, horizons, stride).select("container_name", "window_id", "x", "y_10")
        blocks = windows.window_blocks(df, window, horizons, stride, ("value",), block=70)
        assert blocks.select("container_name", "window_id", F.flatten("x").alias("x"), "y_10").exceptAll(plain).count() == 0
        assert blocks.count() == 234


def test_windows_stay_in_their_series(spark):
    df = series(spark, [1.0] * 40, "a").union(series(spark, [2.0] * 40, "b")).union(series(spark, [3.0] * 9, "short"))
    for r in windows.sliding_windows(df, 8, (3,), 2).collect():
        assert set(r.x) == set(r.y_3) and len(r.x) == 8 and len(r.y_3) == 3
    assert [r.container_name for r in windows.skipped_series(df, 8, (3,)).collect()] == ["short"]
    with pytest.raises(ValueError):
        windows.require_windows(df, 100, (3,))
    assert windows.require_windows(df, 8, (3,)) is df


@pytest.mark.parametrize("n,sizes", [(10, (7, 1, 2)), (37, (25, 6, 6)), (411, (287, 62, 62)), (1, (0, 0, 1))])
def test_split_sizes(spark, n, sizes):
    df = spark.range(n).selectExpr("'m' as metric_name", "'a' as container_name", "id as window_id")
    for scope in ("series", "global"):
        r = split.split_sizes(split.temporal_split(df, "window_id", scope=scope)).first()
        assert (r.n_train, r.n_validation, r.n_test) == sizes


def test_split_follows_time_and_checks_ratios(spark):
    df = spark.range(100).selectExpr("'m' as metric_name", "concat('c', id % 3) as container_name", "id as window_id")
    order = split.temporal_split(df, "window_id").groupBy("container_name", "split").agg(F.min("window_id").alias("a"), F.max("window_id").alias("b")).collect()
    at = {(r.container_name, r.split): (r.a, r.b) for r in order}
    for c in ("c0", "c1", "c2"):
        assert at[c, "train"][1] < at[c, "validation"][0] and at[c, "validation"][1] < at[c, "test"][0]
    for bad in ({"train": 0.9}, {"scope": "x"}):
        with pytest.raises(ValueError):
            split.temporal_split(df, "window_id", **bad)


@pytest.mark.parametrize("method", scale.METHODS)
def test_scaling_back_is_the_identity(spark, method):
    df = series(spark, [3, 1, 4, 1, 5, 9]).withColumn("flat", F.lit(2.0)).withColumn("y_2", F.array("value", F.lit(1.0)))
    scaler = scale.fit_scaler(df, ["value", "flat"], method)
    assert scaler.filter("feature = 'flat'").first().scale == 1.0
    there = scale.apply_scaler(df, scaler, ["value", "flat", "y_2"], names={"y_2": "value"})
    back = scale.apply_scaler(there, scaler, ["value", "flat", "y_2"], inverse=True, names={"y_2": "value"}).orderBy("timestamp").collect()
    assert np.allclose([r.value for r in back], [3, 1, 4, 1, 5, 9]) and np.allclose([r.y_2[0] for r in back], [3, 1, 4, 1, 5, 9])


def test_scalers_refuse_what_they_cannot_do(spark):
    df = series(spark, [1, 2])
    with pytest.raises(ValueError):
        scale.fit_scaler(df, ["value"], "other")
    with pytest.raises(ValueError):
        scale.apply_scaler(df, None, ["value"])
    with pytest.raises(Exception, match="not fitted"):
        scale.apply_scaler(df.withColumn("z", F.lit(1.0)), scale.fit_scaler(df, ["value"]), ["z"]).collect()


def test_vocabulary_keeps_ids(spark):
    df = spark.createDataFrame([("webapp",), ("database",), ("redis",), ("redis",)], "container_name string")
    first = vocabulary.build_vocabulary(df)
    assert {r.container_name: r.container_id for r in first.collect()} == {"database": 0, "redis": 1, "webapp": 2}
    more = vocabulary.extend_vocabulary(first, df.union(spark.createDataFrame([("aaa",)], "container_name string")))
    assert {r.container_name: r.container_id for r in more.collect()} == {"database": 0, "redis": 1, "webapp": 2, "aaa": 3}
    with pytest.raises(Exception, match="unknown container"):
        vocabulary.add_container_ids(spark.createDataFrame([("zzz",)], "container_name string"), first).collect()
    assert vocabulary.add_container_ids(spark.createDataFrame([("zzz",)], "container_name string"), first, strict=False).first().container_no is None
    assert vocabulary.container_names(spark.createDataFrame([(1,)], "container_no int"), first).first().container_name == "redis"
    labelled = spark.createDataFrame([("container=a",), ("pod=b-1f",), ("x=y",)], "container_labels string")
    assert sorted(r[0] for r in vocabulary.discover_containers(labelled).collect()) == ["a", "b"]
    with pytest.raises(ValueError):
        vocabulary.discover_containers(spark.range(1))


def test_correlations(spark):
    rows = [(s, T0 + dt.timedelta(seconds=i), float(v)) for s, vs in {"a": (1, 2, 3, 3), "b": (2, 1, 5, 6), "c": (1, 1, 1, 1)}.items() for i, v in enumerate(vs)]
    aligned = correlate.align(spark.createDataFrame(rows, "series string, timestamp timestamp_ntz, value double"))
    for method, want in (("pearson", 0.8044), ("spearman", 0.737865), ("kendall", 0.5477)):
        got = {(r.series_a, r.series_b): r.r for r in correlate.correlation(aligned, method).collect()}
        assert got[("a", "b")] == pytest.approx(want, abs=1e-4) and got[("a", "c")] is None and got[("b", "c")] is None
    strong = correlate.high_correlations(correlate.pearson(aligned)).collect()
    assert [(r.series_a, r.series_b) for r in strong] == [("a", "b")]


def test_tau_b_by_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(20):
        x, y = rng.integers(0, 6, 40), rng.integers(0, 6, 40)
        i, j = np.triu_indices(40, 1)
        a, b = np.sign(x[i] - x[j]), np.sign(y[i] - y[j])
        assert correlate.tau_b(x, y) == pytest.approx((a * b).sum() / np.sqrt(float((a != 0).sum()) * float((b != 0).sum())))


def test_rates_survive_resets(spark):
    got = rates.counter_rate(series(spark, [10, 20, 5, 15], step=20), 60).orderBy("timestamp").collect()
    assert [r.rate for r in got] == [None, 0.5, 15 / 40, 25 / 60]
    named = series(spark, [10, 40], metric="container_cpu_usage_seconds_total").union(series(spark, [7], metric="container_memory_usage_bytes")).union(series(spark, [7], metric="zzz"))
    assert sorted((r.metric_name, r.value) for r in rates.exported_metrics(named).collect()) == [("container_cpu_rate", 2.0), ("container_memory_usage", 7.0)]


def test_bucket_quantile(spark):
    inf = float("inf")
    rows = [("a", 1.0, 0.0), ("a", 2.0, 10.0), ("a", inf, 10.0), ("b", 1.0, 0.0), ("b", inf, 4.0), ("c", 1.0, 0.0), ("c", inf, 0.0)]
    got = {r.k: r.quantile for r in rates.bucket_quantile(spark.createDataFrame(rows, "k string, le double, count double"), 0.5, ("k",)).collect()}
    assert got == {"a": 1.5, "b": 1.0, "c": None}


def predictions(spark, rows):
    return spark.createDataFrame([("m", "a", w, h, s, float(t), float(p)) for w, h, s, t, p in rows], "metric_name string, container_name string, window_id long, horizon int, step int, y_true double, y_pred double")


def test_scores(spark):
    r = evaluate.score(predictions(spark, [(0, 2, 0, 1, 2), (0, 2, 1, 0, 0), (1, 2, 0, 3, 3), (1, 2, 1, 4, 2)])).first()
    assert (r.n, r.mae, r.mape) == (4, 0.75, pytest.approx(50.0)) and r.rmse == pytest.approx(np.sqrt(5 / 4)) and r.r2 == pytest.approx(1 - 5 / 10)
    same = lambda p: evaluate.score(predictions(spark, [(0, 1, 0, 2, p), (1, 1, 0, 2, p)])).first().r2
    assert (same(2), same(3)) == (1.0, 0.0)
    moves = evaluate.directional_accuracy(predictions(spark, [(0, 3, 0, 1, 1), (0, 3, 1, 2, 5), (0, 3, 2, 2, 6), (1, 1, 0, 1, 1)])).collect()
    assert [(r.horizon, r.directional_accuracy) for r in moves] == [(3, 50.0)]
    with pytest.raises(ValueError):
        evaluate.loss(predictions(spark, []), "zzz")


def test_arima_recovers_coefficients_and_falls_back():
    rng = np.random.default_rng(0)
    x = [0.0, 0.0]
    for _ in range(4000):
        x.append(0.6 * x[-1] - 0.3 * x[-2] + rng.normal())
    assert np.allclose(forecast.Fitted(np.array(x), (2, 0, 0)).beta, [0.6, -0.3], atol=0.05)
    e = rng.normal(size=5000)
    assert np.allclose(forecast.Fitted(e[1:] + 0.5 * e[:-1], (0, 0, 1)).beta, [0.5], atol=0.06)
    line = np.arange(50.0)
    assert np.allclose(forecast.arima(line, 5, (1, 1, 0)), np.arange(50, 55))
    wave = np.tile([1.0, 5, 2, 8], 20) + np.arange(80)
    assert np.allclose(forecast.arima(wave, 8, (1, 0, 0), (0, 1, 0, 4)), np.tile([1.0, 5, 2, 8], 2) + np.arange(80, 88), atol=0.5)
    assert forecast.arima(np.array([3.0]), 2).tolist() == [3.0, 3.0]
    assert np.isnan(forecast.arima(np.array([]), 1)).all()


def test_order_search_prefers_the_true_order(spark):
    rng = np.random.default_rng(1)
    x = [0.0]
    for _ in range(600):
        x.append(0.8 * x[-1] + rng.normal())
    r = forecast.search_orders(series(spark, x), [(0, 0, 0), (1, 0, 0), (0, 1, 0)]).first()
    assert (r.p, r.d, r.q) == (1, 0, 0)
    short = forecast.search_orders(series(spark, [1.0, 2.0]), [(3, 0, 0)]).first()
    assert (short.p, short.d, short.q) == forecast.DEFAULT and short.aic is None


@pytest.mark.parametrize("order,seasonal", [((1, 1, 1), (0, 0, 0, 0)), ((1, 1, 0), (0, 0, 0, 0)), ((2, 0, 2), (0, 0, 0, 0)), ((1, 0, 0), (1, 1, 0, 24)), ((0, 1, 1), (0, 1, 1, 6)), ((0, 0, 0), (0, 0, 0, 0))])
def test_arima_of_a_series_over_many_blocks_is_that_of_the_whole(spark, order, seasonal):
    rng, x = np.random.default_rng(4), [5.0]
    for k in range(900):
        x.append(0.7 * x[-1] + np.sin(k / 4) + rng.normal())
    long, short = np.array(x) + 1e4, np.array(x[:9])
    holes = [None if k % 50 == 3 else v for k, v in enumerate(long)]
    df = series(spark, long, metric="long").union(series(spark, short, metric="short")).union(series(spark, holes, metric="holes")).union(series(spark, [2.0] * 400, metric="flat")).union(series(spark, [float("nan")], metric="none"))
    df = df.withColumn("container_name", F.when(F.col("metric_name") == "holes", None).otherwise(F.col("container_name")))
    found = forecast.forecast_series(df, 7, order, seasonal, block=100)
    plan = found._jdf.queryExecution().toString()
    assert "_block" in plan and "_block" not in forecast.forecast_series(df, 7, order, seasonal)._jdf.queryExecution().toString()
    got = found.toPandas().sort_values("step").groupby("metric_name")["forecast"].apply(list).to_dict()
    want = {"long": long, "short": short, "holes": np.array([v for v in holes if v is not None]), "flat": np.full(400, 2.0)}
    assert set(got) == set(want)
    for name, values in want.items():
        assert np.allclose(got[name], forecast.arima(values, 7, order, seasonal), rtol=1e-9, atol=1e-9), name


def test_search_over_many_blocks_is_that_of_one(spark):
    rng, x = np.random.default_rng(6), [0.0]
    for _ in range(500):
        x.append(0.6 * x[-1] + rng.normal())
    df = series(spark, x, metric="a").union(series(spark, np.cumsum(x), metric="b")).union(series(spark, x[:60], metric="c")).union(series(spark, [3.0] * 300, metric="flat"))
    orders = forecast.order_grid(1, 1, 1)
    one, many = (sorted(tuple(r) for r in forecast.search_orders(df, orders, "bic", block=b).collect()) for b in (forecast.BLOCK, 60))
    assert [r[:5] for r in one] == [r[:5] for r in many]
    assert np.allclose([r[5] for r in one], [r[5] for r in many], rtol=1e-8)
    assert [r[2:5] for r in one] == [(1, 0, 0), (1, 1, 0), (1, 0, 0), (0, 1, 0)]
    with pytest.raises(ValueError):
        forecast.search_orders(df, orders, "r2")


@pytest.mark.parametrize("width", [2, 5, 500])
def test_correlation_by_blocks_of_series_is_numpys(spark, width):
    rng = np.random.default_rng(5)
    base = rng.normal(size=60)
    values = {f"s{k}": base * (k - 4) + rng.normal(size=60) for k in range(11)} | {"flat": np.full(60, 3.0)}
    rows = [(name, T0 + dt.timedelta(seconds=k), float(v)) for name, column in values.items() for k, v in enumerate(column)]
    aligned = spark.createDataFrame(rows, "series string, timestamp timestamp_ntz, value double")
    got = {(r.series_a, r.series_b): r.r for r in correlate.pearson(aligned, width).collect()}
    assert len(got) == 66
    for (a, b), r in got.items():
        assert r is None if "flat" in (a, b) else abs(r - np.corrcoef(values[a], values[b])[0, 1]) < 1e-9


@pytest.mark.parametrize("most_rows,ranges", [(10_000, 500), (40, 500), (7, 500), (40, 3)])
def test_kendall_by_ranges_equals_all_pairs(spark, most_rows, ranges):
    rng = np.random.default_rng(3)
    base = rng.normal(size=220)
    values = {"a": base, "b": np.round(base + rng.normal(size=220)), "c": np.where(rng.uniform(size=220) < 0.5, 1.0, rng.integers(0, 9, 220)), "d": -base, "flat": np.full(220, 2.0)}
    rows = [(name, T0 + dt.timedelta(seconds=k), float(v)) for name, column in values.items() for k, v in enumerate(column)]
    aligned = spark.createDataFrame(rows, "series string, timestamp timestamp_ntz, value double")
    got = {(r.series_a, r.series_b): r.r for r in correlate.kendall(aligned, most_rows, ranges).collect()}
    i, j = np.triu_indices(220, 1)
    assert len(got) == 10
    for (a, b), r in got.items():
        x, y = (np.sign(values[n][i] - values[n][j]) for n in (a, b))
        if "flat" in (a, b):
            assert r is None
        else:
            assert abs(r - (x * y).sum() / np.sqrt(np.abs(x).sum() * np.abs(y).sum())) < 1e-12


def spread(spark, seed, n=400):
    """Two series over some days, with gaps, equal times, nulls and resets."""
    rng, rows = np.random.default_rng(seed), []
    for name in ("a", None):
        at, value = 0.0, 0.0
        for k in range(n):
            at += float(rng.choice([0, 40, 900, 1_000])) if k % 90 else 200_000.0
            value = float(rng.integers(0, 5)) if rng.uniform() < 0.05 else value + float(rng.integers(0, 9))
            rows.append(("m", name, T0 + dt.timedelta(seconds=at), None if rng.uniform() < 0.3 or k < 120 and name else value, k))
    return spark.createDataFrame(rows, f"{SAMPLES}, event_id long")


def test_fills_over_days_equal_fills_of_the_whole_series(spark):
    df = spread(spark, 1)
    got = clean.fill_unlimited(df)
    pdf = df.toPandas().sort_values(["timestamp", "event_id"])
    want = pdf.groupby("container_name", dropna=False)["value"].transform(lambda v: v.ffill().bfill())
    want = dict(zip(zip(pdf["container_name"], pdf["event_id"]), want))
    rows = got.collect()
    assert len(rows) == 800 and got.columns == df.columns
    assert all(r.value == want[r.container_name, r.event_id] for r in rows)


@pytest.mark.parametrize("seconds", [60, 5_000, 86_400, 260_000])
def test_rates_over_blocks_equal_rates_of_the_whole_series(spark, seconds):
    df = spread(spark, 2).filter("value is not null")
    got = {(r.container_name, r.event_id): r.rate for r in rates.counter_rate(df, seconds).collect()}
    pdf, n = df.toPandas(), 0
    for name, g in pdf.groupby("container_name", dropna=False):
        g = g.sort_values(["timestamp", "event_id"])
        t, v = ((g["timestamp"] - pd.Timestamp(T0)).dt.total_seconds()).to_numpy(), g["value"].to_numpy()
        grown = np.concatenate([[0.0], np.where(v[1:] < v[:-1], v[1:], v[1:] - v[:-1])])
        for i, event in enumerate(g["event_id"]):
            inside = np.flatnonzero((t >= t[i] - seconds) & (t <= t[i]))
            covered = t[i] - t[inside[0]]
            want = grown[inside[1:]].sum() / covered if covered > 0 else None
            r = got[None if pd.isna(name) else name, event]
            assert r == want if want is None else abs(r - want) < 1e-9
            n += 1
    assert n == len(got)


def test_seasonal_trend_follows_a_daily_wave(spark):
    t = np.arange(24 * 10)
    y = 10 + 0.02 * t + 3 * np.sin(2 * np.pi * t / 24)
    got = forecast.forecast_seasonal_trend(series(spark, y, step=3600), 24, 3600).orderBy("timestamp").toPandas()
    ahead = np.arange(240, 264)
    assert np.abs(got["forecast"] - (10 + 0.02 * ahead + 3 * np.sin(2 * np.pi * ahead / 24))).max() < 0.6
    assert (got["lower"] <= got["forecast"]).all() and got["timestamp"].iat[0] == pd.Timestamp(T0) + pd.Timedelta(hours=240)


@pytest.mark.parametrize("params", [{}, {"daily": 0, "weekly": 0, "changepoints": 0}, {"yearly": 2, "changepoints": 3, "level": 0.8}])
def test_trends_over_many_blocks_are_those_of_the_whole(spark, params):
    rng, t = np.random.default_rng(7), np.arange(24 * 12)
    y = 1000 + 0.5 * t + 30 * np.sin(2 * np.pi * (t + 5) / 24) + rng.normal(size=len(t))
    start = T0 + dt.timedelta(hours=7, minutes=13)
    df = series(spark, y, metric="long", step=3600, start=start).union(series(spark, [4.0, None, 6.0], metric="short", step=3600, start=start))
    got = forecast.forecast_seasonal_trend(df, 30, 3600, block=50, **params).toPandas().sort_values("timestamp")
    second = (start - dt.datetime(1970, 1, 1)).total_seconds()
    for metric, values in (("long", y), ("short", np.array([4.0, 6.0]))):
        mine = got[got["metric_name"] == metric]
        n = len(values)
        model = forecast.Trend(n, 3600, second, **params)
        x = model.columns(np.arange(n + 30))
        beta = np.linalg.solve(x[:n].T @ x[:n] + np.diag(model.penalty), x[:n].T @ (values - values.mean()))
        fit = x @ beta + values.mean()
        spread = model.z * np.std(values - fit[:n])
        assert np.allclose(mine["forecast"], fit[n:], rtol=1e-7)
        assert np.allclose(mine["upper"] - mine["lower"], 2 * spread, rtol=1e-5, atol=1e-4)


def test_scoring_by_metric(spark):
    df = series(spark, [1, 2, 3, 4], metric="x").union(series(spark, [5, 5], metric="y"))
    scalers = spark.createDataFrame([("x", 2.0, 0.5)], "feature string, center double, scale double")
    got = forecast.batch_score(df, {"x": lambda v, n: np.full(n, v[-1])}, scalers, 2).collect()
    assert [(r.metric_name, r.forecast) for r in got] == [("x", 4.0)] * 2
    with pytest.raises(ValueError):
        forecast.batch_score(df, {}, scalers, 2)


def test_empty_input(spark):
    none = series(spark, [])
    assert clean.clip_outliers(clean.regular_grid(none)).count() == 0
    assert features.add_features(none).count() == 0
    assert windows.sliding_windows(none, 4, (2,), 1).count() == 0
    assert correlate.pearson(correlate.align(correlate.named_series(none))).count() == 0
    assert forecast.forecast_series(none, 3).count() == 0


def test_training_data_end_to_end(spark):
    labelled = many(spark, 600).withColumn("container_labels", F.concat(F.lit("container="), "container_name"))
    data, names = pipelines.prepare_training_data(labelled.drop("container_name"), "m", window=60, horizons=(10, 20), stride=10)
    assert names.count() == 3
    shares = split.container_shares(data).collect()
    assert len(shares) == 3 and all(r.percent >= 10 for r in shares)
    scaled, scalers = pipelines.scale_training_data(data, (10, 20))
    stats = scaled.filter("split = 'train'").select(F.explode("y_10").alias("v")).agg(F.avg("v"), F.stddev_pop("v")).first()
    assert stats[0] == pytest.approx(0, abs=1e-9) and stats[1] == pytest.approx(1)
    assert {r.feature for r in scalers.collect()} == {"y_10", "y_20"}


def test_windows_keep_nulls_in_both_forms(spark):
    values = [float(i) if i not in (3, 4, 9) else None for i in range(12)]
    df = series(spark, values)
    plain = windows.sliding_windows(df, 4, (2,), 2).orderBy("window_id").collect()
    blocks = windows.window_blocks(df, 4, (2,), 2, ("value",), block=6).orderBy("window_id").collect()
    assert [list(r.x) for r in plain] == [values[k : k + 4] for k in (0, 2, 4, 6)]
    assert [list(r.y_2) for r in plain] == [values[k + 4 : k + 6] for k in (0, 2, 4, 6)]
    assert [[c[0] for c in r.x] for r in blocks] == [list(r.x) for r in plain]
    assert [list(r.y_2) for r in blocks] == [list(r.y_2) for r in plain]


def test_rows_are_numbered_day_by_day(spark):
    df = series(spark, range(500), step=1200).union(series(spark, range(3), "b", step=86_400)).repartition(5)
    got = windows.numbered_by_days(df).collect()
    assert all(r.row_no == r.value and r.n_rows == (500 if r.container_name == "a" else 3) for r in got)


def test_too_short_series_raise_in_the_pipeline(spark):
    df = series(spark, range(100))
    with pytest.raises(ValueError, match="no series has"):
        pipelines.features_and_windows(df, 240, (60,))
    assert pipelines.features_and_windows(df, 20, (10,), with_lags=False, with_rolling=False).count() > 0


def test_sums_along_an_order(spark):
    from pulsegrid.operators.order import sums_before

    rng = np.random.default_rng(3)
    rows = [(f"n{x:03d}" if x % 7 else None, int(x), int(w)) for x, w in zip(rng.permutation(300), rng.integers(1, 9, 300))]
    df = spark.createDataFrame(rows, "name string, k int, w int")
    for blocks in (1, 16, 1000):
        got = sorted(sums_before(df, ["name", "k"], F.col("w"), blocks).collect(), key=lambda r: (r["name"] is not None, r["name"] or "", r.k))
        before = np.concatenate([[0], np.cumsum([r.w for r in got])])
        assert [r._before for r in got] == before[:-1].tolist() and {r._total for r in got} == {before[-1]}
    assert sums_before(df.limit(0), ["name"], F.col("w")).count() == 0


def test_inputs_of_several_features_are_scaled_by_the_training_part(spark):
    rows = [("m", "a", k, [[float(k + i), 5.0] for i in range(3)], [float(k)], "train" if k < 4 else "test") for k in range(6)]
    data = spark.createDataFrame(rows, "metric_name string, container_name string, window_id long, x array<array<double>>, y_1 array<double>, split string")
    scaled, targets = pipelines.scale_training_data(data, (1,))
    scalers = pipelines.input_scalers(data)
    seen = np.array([k + i for k in range(4) for i in range(3)], dtype=float)
    stats = {r.feature: (r.center, r.scale) for r in scalers.collect()}
    assert stats["x_0"] == pytest.approx((seen.mean(), seen.std())) and stats["x_1"] == (5.0, 1.0)
    assert [r.feature for r in targets.collect()] == ["y_1"]
    for r in scaled.collect():
        assert np.allclose(r.x, [[(r.window_id + i - seen.mean()) / seen.std(), 0.0] for i in range(3)])
    back = scale.apply_input_scaler(scaled, scalers, inverse=True)
    assert all(np.allclose(r.x, rows[r.window_id][3]) for r in back.collect())


def test_evaluation_adds_directions_and_writes_results(spark, tmp_path):
    data = spark.createDataFrame([("m", "a", 0, [float(v % 5) for v in range(40)], [1.0, 2.0, 1.0], "test")], "metric_name string, container_name string, window_id long, x array<double>, y_3 array<double>, split string")
    path = str(tmp_path / "results")
    by_horizon, _, _ = pipelines.evaluate_forecasts(data, (3,), (1, 1, 0), path=path)
    row = by_horizon.first()
    assert 0 <= row.directional_accuracy <= 100 and row.horizon == 3
    back = spark.read.json(path).first()
    assert back.directional_accuracy == row.directional_accuracy and back.rmse == pytest.approx(row.rmse)


def test_long_actuals_and_predictions_pair_by_step(spark):
    key = "metric_name string, container_name string, window_id long, horizon int, step int"
    actual = spark.createDataFrame([("m", "a", 0, 2, k, float(k)) for k in range(2)], f"{key}, y_true double")
    predicted = spark.createDataFrame([("m", "a", 0, 2, k, k + 1.0) for k in range(3)], f"{key}, y_pred double")
    paired = evaluate.pair_rows(actual, predicted)
    assert paired.count() == 2 and evaluate.score(paired).first().mae == 1.0


@pytest.mark.parametrize("order", [(1, 1, 0), (2, 0, 0), (3, 2, 0), (0, 1, 0), (0, 0, 0), (1, 1, 1)])
def test_windows_fitted_together_as_one_by_one(order):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(6, 60)).cumsum(axis=1) * 1e3 + 5e4, np.full((1, 60), 7.0), np.arange(60.0)[None], rng.normal(size=(1, 60))])
    x[2, 9] = np.nan
    want = np.stack([forecast.arima(v, 12, order) for v in x])
    assert np.allclose(forecast.arima_windows(x, 12, order), want, rtol=1e-9, atol=1e-9)
    short = x[:, :3]
    assert np.allclose(forecast.arima_windows(short, 2, order), np.stack([forecast.arima(v, 2, order) for v in short]))
    assert forecast.arima_windows(x[:0], 4, order).shape == (0, 4)


def test_per_window_in_batches_of_any_lengths(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 4.0, 8.0, 16.0, 32.0]), (2, [3.0, 1.0]), (3, [])], "i int, x array<double>")
    for many, fit in ((True, forecast.arima_windows), (False, forecast.arima)):
        got = {r.i: r for r in windows.per_window(df.coalesce(1), fit, (1, 3), many=many, order=(1, 1, 0)).collect()}
        assert got[1].pred_3 == pytest.approx([64, 128, 256]) and got[1].pred_1 == pytest.approx([64])
        assert got[2].pred_3 == [1.0] * 3 and np.isnan(got[3].pred_1).all()


@pytest.mark.parametrize("width,times", [(1000, 500), (3, 4), (2, 500), (1000, 1)])
def test_correlation_of_runs_is_that_of_aligned_rows(spark, width, times):
    rng = np.random.default_rng(8)
    rows = [(f"s{i}", T0 + dt.timedelta(seconds=int(t)), None if v < 0.1 else float(round(v * 6))) for i in range(7) for t, v in zip(rng.integers(0, 60, 12 + 5 * i), rng.random(12 + 5 * i))]
    rows += [("flat", T0 + dt.timedelta(seconds=3), 2.0), ("none", T0 + dt.timedelta(seconds=90), None), ("none", T0, None), ("late", T0 + dt.timedelta(seconds=70), 1.0), ("late", T0 + dt.timedelta(seconds=80), 5.0)]
    df = spark.createDataFrame(rows, "series string, timestamp timestamp_ntz, value double").repartition(5)
    aligned, found = correlate.align(df), correlate.runs(df)
    assert found.groupBy("series").agg(F.sum("n").alias("n")).select("n").distinct().collect() == [(aligned.select("timestamp").distinct().count(),)]
    for want, got in ((correlate.pearson(aligned), found), (correlate.spearman(aligned), correlate.ranked_runs(found))):
        want = {(r.series_a, r.series_b): r.r for r in want.collect()}
        got = {(r.series_a, r.series_b): r.r for r in correlate.pearson_of_runs(got, width, times).collect()}
        assert got.keys() == want.keys() and len(got) == 45
        for pair, r in want.items():
            assert (r is None) == (got[pair] is None) and (r is None or got[pair] == pytest.approx(r, abs=1e-9)), pair
    assert correlate.correlation_of_samples(df.limit(0)).count() == 0


def test_a_rate_looks_at_a_sample_once_however_long_its_range_is(spark):
    # a bounded frame by time goes through all samples of the range for each sample
    plan = rates.counter_rate(series(spark, range(5)), 3_600)._jdf.queryExecution().optimizedPlan().toString()
    assert "RangeFrame, -" not in plan and "specifiedwindowframe(RangeFrame, unboundedpreceding$(), currentrow$())" in plan


def test_a_correlation_group_holds_two_blocks_of_a_chunk(spark):
    rng = np.random.default_rng(6)
    rows = [(f"s{k}", T0 + dt.timedelta(hours=h), float(v)) for k in range(40) for h, v in enumerate(rng.normal(size=90))]
    df = spark.createDataFrame(rows, "series string, timestamp timestamp_ntz, value double")
    want = {(r.series_a, r.series_b): r.r for r in correlate.pearson(df).collect()}
    plan = correlate.pearson(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" not in plan and "FlatMapGroupsInArrow [_one" in plan.replace("#", " #")
    for width, times in ((7, 90), (7, 20), (40, 13)):
        got = {(r.series_a, r.series_b): r.r for r in correlate.pearson(df, width, times).collect()}
        assert got.keys() == want.keys() and len(got) == 780 and all(abs(got[k] - want[k]) < 1e-12 for k in got)
