"""Queries that must take the whole input and all of the operator's choices."""

import datetime as dt

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid import queries as core
from pulsegrid.operators import forecast, lagsums
from pulsegrid.plans import pipelines

T0 = dt.datetime(2024, 1, 1)
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def events(spark, path, rows):
    """Writes (hour, user, type, value) as an events table."""
    full = [(i, T0 + dt.timedelta(hours=h), u, kind, float(v), '{"k": 1}') for i, (h, u, kind, v) in enumerate(rows)]
    spark.createDataFrame(full, EVENTS).write.parquet(f"{path}/events.parquet")
    return str(path)


def least_errors(y, order, first):
    """Mean squared one-step errors by a plain recursion over the values from ``first`` on, from 300 starts."""
    p, d, q = order
    w = np.diff(y - y.mean(), d)
    best, rng = np.inf, np.random.default_rng(0)

    def errors(b):
        e = np.zeros(len(w))
        for t in range(len(w)):
            e[t] = w[t] - sum(b[i] * w[t - 1 - i] for i in range(min(p, t))) - sum(b[p + i] * e[t - 1 - i] for i in range(min(q, t)))
        return float(np.mean(e[first - d :] ** 2))

    point = np.zeros(p + q)
    for scale in (0.3, 0.1, 0.03, 0.01, 0.003):
        for _ in range(60):
            new = point + scale * rng.normal(size=p + q)
            if (q == 0 or np.abs(np.roots([1, *new[p:]])).max() < 0.99) and (v := errors(new)) < best:
                best, point = v, new
    return best


def test_order_search_tries_all_48_orders(spark, tmp_path):
    rng, y = np.random.default_rng(5), [0.0, 0.0, 0.0]
    for _ in range(400):
        y.append(0.3 * y[-1] - 0.2 * y[-2] + 0.6 * y[-3] + rng.normal())
    y = np.round(y[3:], 6)
    assert len(forecast.order_grid()) == 48
    row = core.queries()["m3_order_search"](spark, events(spark, tmp_path / "t", [(h, 1, "click", v) for h, v in enumerate(y)])).first()
    # a plain regression on three lags, over the rows that all orders share
    v, first = y - y.mean(), forecast.MEMORY + 2
    lags = np.column_stack([v[first - k : len(v) - k] for k in (1, 2, 3)])
    rest = v[first:] - lags @ np.linalg.lstsq(lags, v[first:], rcond=None)[0]
    known = len(rest) * np.log(np.mean(rest**2)) + 2 * (3 + 1 + 1)
    assert row.aic <= known + 1e-6 and row.p + row.q >= 3
    found = forecast.Innovations(lag_matrices(y), len(y) - first)
    assert found.criterion((3, 0, 0)) == pytest.approx(known, abs=1e-6)
    assert row.aic == pytest.approx(min(found.criterion(o) for o in forecast.order_grid()), abs=1e-5)


def lag_matrices(y, memory=forecast.MEMORY, most_d=2):
    v, out = y - y.mean(), []
    for d in range(most_d + 1):
        w = np.diff(v, d)
        rows = np.array([[w[t - d - k] for k in range(memory + 1)] for t in range(memory + most_d, len(y))])
        out.append(rows.T @ rows)
    return out


@pytest.mark.parametrize("order", [(0, 0, 1), (1, 0, 1), (0, 1, 2), (1, 1, 0)])
def test_errors_of_an_order_are_the_least_of_its_recursion(order):
    rng = np.random.default_rng(8)
    e = rng.normal(size=500)
    y = e.copy()
    for t in range(1, 500):
        y[t] += 0.5 * y[t - 1] * (order[0] > 0) + 0.4 * e[t - 1] * (order[2] > 0)
    y = np.cumsum(y) if order[1] else y
    found = forecast.Innovations(lag_matrices(y), 500 - 34).variance(order)[0]
    plain = least_errors(y, order, 34)
    assert found <= plain * (1 + 1e-6) and found == pytest.approx(plain, rel=2e-3)


@pytest.mark.parametrize("kind", ["ar", "ma", "walk"])
def test_orders_are_found_whatever_the_unit(kind):
    right = {"bic": 0, "aic": 0}
    for seed in range(10):
        rng = np.random.default_rng(seed)
        e = rng.normal(size=700)
        y = e.copy()
        for t in range(1, 700):
            y[t] += 0.6 * y[t - 1] if kind != "ma" else 0.5 * e[t - 1]
        y = np.cumsum(y) if kind == "walk" else y
        for name in right:
            orders = [forecast.best_order(forecast.Innovations(lag_matrices(y * unit), 700 - 34), forecast.order_grid(2, 1, 2), name)[1] for unit in (1.0, 1000.0, 0.001)]
            assert len(set(orders)) == 1
            right[name] += orders[0] == {"ar": (1, 0, 0), "ma": (0, 0, 1), "walk": (1, 1, 0)}[kind]
    # the price of two for each coefficient is known to take more of them than there are
    assert right["bic"] >= 9 and right["aic"] >= 4


def test_hourly_kendall_by_brute_force(spark, tmp_path):
    rng = np.random.default_rng(2)
    values = {u: rng.integers(0, 9, 100) / 4 for u in (0, 1, 2)}
    path = events(spark, tmp_path / "t", [(h, u, "click", v[h]) for u, v in values.items() for h in range(100)])
    got = {(r.series_a, r.series_b): r.r for r in core.queries()["a15_kendall_hourly"](spark, path).collect()}
    assert set(got) == {("click/c0", "click/c1"), ("click/c0", "click/c2"), ("click/c1", "click/c2")}
    i, j = np.triu_indices(100, 1)
    for (a, b), r in got.items():
        x, y = (np.sign(values[int(n[-1])][i] - values[int(n[-1])][j]) for n in (a, b))
        assert r == pytest.approx((x * y).sum() / np.sqrt(np.abs(x).sum() * np.abs(y).sum()), abs=1e-6)


def test_export_takes_all_event_types(spark, tmp_path):
    kinds = ("click", "view", "purchase", "signup", "error")
    path = events(spark, tmp_path / "t", [(h, 1, kind, 10 * h) for kind in kinds for h in range(5)])
    got = {r.metric_name: (r.n, r.total) for r in core.queries()["e9_export_metrics"](spark, path).collect()}
    # a counter's first sample has no rate; the others rise by 10 an hour
    rate = (4, pytest.approx(4 * 10 / 3600, abs=1e-6))
    assert got == {"container_memory_usage": (5, 100.0), **{f"container_{k}_rate": rate for k in ("cpu", "fs_reads", "network_receive", "fs_writes")}}


def test_ties_of_rounding_are_not_left_to_the_order_of_a_sum(spark):
    import duckdb

    half = 48.2384375  # a mean of 32 values of two digits
    values = [half, float(np.nextafter(half, 0)), float(np.nextafter(half, 99)), half - 1e-8, -half]
    got = [r.v for r in spark.createDataFrame([(v,) for v in values], "v double").select(core.settled(F.col("v"), 6).alias("v")).collect()]
    assert got == [48.238438, 48.238438, 48.238438, 48.238437, -48.238437]
    assert [duckdb.execute(f"select {core.settled_sql('?::DOUBLE', 6)}", [v]).fetchall()[0][0] for v in values] == got


def test_targets_are_scored_as_they_were(spark):
    rng = np.random.default_rng(3)
    rows = [("m", "c", k, "train" if k < 8 else "test", rng.uniform(0, 900, 48).round(2).tolist(), [0.01, 812.3, 0.07, 0.33]) for k in range(10)]
    data = spark.createDataFrame(rows, "metric_name string, container_name string, window_id long, split string, x array<double>, y_4 array<double>")
    scaled, scalers = pipelines.scale_training_data(data, (4,), keep=True)
    assert [r.true_4 for r in scaled.collect()] == [r[-1] for r in rows]
    by_horizon = pipelines.evaluate_forecasts(scaled, (4,), (0, 0, 0), scalers, seasonal=(0, 1, 0, 24))[0].first()
    assert by_horizon.n == 8 and by_horizon.directional_accuracy is not None
    shifted = scaled.withColumn("y_4", F.transform("y_4", lambda v: v + 5.0))  # scaled targets do not matter
    again = pipelines.evaluate_forecasts(shifted, (4,), (0, 0, 0), scalers, seasonal=(0, 1, 0, 24))[0].first()
    assert again == by_horizon


def test_order_search_tries_no_step_that_promises_nothing(monkeypatch):
    """Without shocks, least squares are the end of it; the criteria of all orders are those of a long search."""
    calls, inverse = [], forecast._inverse
    monkeypatch.setattr(forecast, "_inverse", lambda *a: calls.append(a) or inverse(*a))
    v = np.random.default_rng(4).normal(size=500)
    lags = tuple(range(forecast.MEMORY + 1))
    found = forecast.Innovations([lagsums.products_of(np.diff(v, d), lags, forecast.MEMORY + 2 - d) for d in range(3)], 500 - forecast.MEMORY - 2)
    found.variance((2, 0, 0))
    assert len(calls) == 1
    for theta in ([], [0.98], [0.995], [-0.995], [1.2, 0.5], [1.2, 0.1], [0.1, 0.2, 0.98], [3.0, 3.0, 0.9]):
        assert forecast._invertible(np.array(theta)) == bool(np.abs(np.roots([1.0, *theta])).max(initial=0.0) < 0.99)


def test_features_are_made_once_for_windows(spark):
    rows = [("cpu", c, T0 + dt.timedelta(hours=h), float(h % 7)) for c, n in (("a", 130), ("b", 40)) for h in range(n)]
    df = spark.createDataFrame(rows, "metric_name string, container_name string, timestamp timestamp_ntz, value double")
    out = pipelines.features_and_windows(df, 20, (10,), 4)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.container_name, r.window_id) for r in out.collect()} == {("a", k) for k in range(20)}
    with pytest.raises(ValueError):
        pipelines.features_and_windows(df.filter("container_name = 'b'"), 20, (10,), 4)


def test_a_range_that_begins_with_equal_times_leaves_out_the_first_by_event_id(spark, tmp_path):
    rows = [(h // 5, 4 * (h % 5), "click", (h * h) % 37) for h in range(400)]
    path = events(spark, tmp_path, rows)
    got = {r.event_id: r.rate for r in core.queries()["a24_counter_rate"](spark, path).collect()}
    # the query's SQL leaves the first of equal times to chance; here it is named
    named = core.oracle_sql()["a24_counter_rate"].replace("first_value(coalesce(grown, 0))", "first_value(coalesce(grown, 0) ORDER BY timestamp, event_id)")
    assert "ORDER BY timestamp, event_id) OVER f" in named
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{path}/events.parquet/*.parquet'")
    want = dict(con.execute(named).fetchall())
    assert len(got) == 400 and got == want and sum(r is None for r in got.values()) == 5
