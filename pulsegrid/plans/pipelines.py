"""The pipelines that users start from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import label_selector, metric_of, select_containers, select_metric, with_container_name
from ..functions.scalars import settled
from ..keys import SERIES, TIME, micros_between
from ..operators import clean, correlate, evaluate, explore, features, forecast, rates, scale, split, vocabulary, windows
from ..sources import io


def prepare_metric_data(df: DataFrame, metric: str | None = None, container: str | None = None, containers: list[str] | None = None, step: int = 15, limit: int = 3, threshold: float | None = 3.0, kind_of: dict[str, str] | None = None) -> DataFrame:
    """Names, selection, units, regular grid, complete rows, clipped outliers."""
    rows = df if "container_name" in df.columns else with_container_name(df)
    if "metric_name" not in rows.columns:
        rows = rows.withColumn("metric_name", F.lit(metric_of(metric or "cpu")))
    elif metric is not None:
        rows = select_metric(rows, metric)
    rows = select_containers(rows, container, containers)
    rows = clean.convert_units(rows, kind_of)
    grid = clean.drop_incomplete(clean.regular_grid(rows.select(*SERIES, TIME, "value"), step, limit))
    return clean.clip_outliers(grid, threshold)


def prepare_container_metrics(df: DataFrame, metric: str, container: str | None = None, step: int = 15, limit: int = 3) -> DataFrame:
    """Selection and regular grid; gaps that are too long stay null."""
    rows = select_containers(select_metric(df, metric), container)
    return clean.regular_grid(rows.select(*SERIES, TIME, "value"), step, limit)


def features_and_windows(df: DataFrame, window: int = 240, horizons: tuple[int, ...] = (60,), stride: int = 4, with_calendar: bool = True, with_lags: bool = True, with_rolling: bool = True, target: str = "value", in_blocks: bool = True) -> DataFrame:
    """Features of a clean series, then windows over all of them; raises where every series is too short for one.

    The features' windows go through whole series in time order already, so their rows are numbered there
    (``numbered``); counting them by days first would make all features once more.  A job looks for one
    series that is long enough.
    """
    table = features.add_features(df, with_calendar=with_calendar, with_lags=with_lags, with_rolling=with_rolling)
    columns = tuple(features.feature_columns(table))
    if not in_blocks:
        windows.require_windows(table, window, horizons)
        return windows.sliding_windows(table, window, horizons, stride, columns, target)
    rows = windows.numbered(table)
    if rows.filter(F.col("n_rows") >= window + max(horizons)).isEmpty():
        raise ValueError(f"no series has the {window + max(horizons)} rows that a window needs")
    return windows.numbered_window_blocks(rows, window, horizons, stride, columns, target)


def multi_horizon_windows(df: DataFrame, window: int = 240, horizons: tuple[int, ...] = (20, 60, 120), stride: int = 4, **families: bool) -> DataFrame:
    return features_and_windows(df, window, horizons, stride, **families)


def prepare_training_data(df: DataFrame, metric: str, containers: list[str] | None = None, step: int = 15, window: int = 240, horizons: tuple[int, ...] = (20, 60, 120), stride: int = 4, ratios: tuple[float, float, float] = (0.7, 0.15, 0.15), scope: str = "series") -> tuple[DataFrame, DataFrame]:
    """(windows with container number and split, vocabulary)."""
    tidy = prepare_metric_data(df, metric, containers=containers, step=step)
    names = vocabulary.build_vocabulary(tidy)
    cut = multi_horizon_windows(tidy, window, horizons, stride)
    return split.temporal_split(vocabulary.add_container_ids(cut, names), "window_id", *ratios, scope), names


def input_scalers(data: DataFrame, method: str = "standard") -> DataFrame:
    """Scalers of the inputs, one a feature, fitted on the training part."""
    return scale.fit_input_scalers(data.filter("split = 'train'"), method)


def scale_training_data(data: DataFrame, horizons: tuple[int, ...], method: str = "standard", inputs: bool = True, keep: bool = False, digits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(scaled windows, target scalers): inputs by ``input_scalers``, targets by one scaler a horizon.

    All are fitted on the training part and applied to every part.  ``keep`` adds the targets as they
    were, ``true_<h>``; ``digits`` rounds the scalers, which then don't depend on the order of sums.
    """

    def rounded(scaler: DataFrame) -> DataFrame:
        return scaler if digits is None else scaler.withColumns({c: settled(F.col(c), digits) for c in ("center", "scale")})

    scalers = rounded(scale.fit_target_scalers(data.filter("split = 'train'"), horizons, method))
    kept = data.withColumns({f"true_{h}": F.col(f"y_{h}") for h in horizons}) if keep else data
    out = scale.apply_scaler(kept, scalers, [f"y_{h}" for h in horizons])
    return (scale.apply_input_scaler(out, rounded(input_scalers(data, method))) if inputs else out), scalers


def analyze_patterns(df: DataFrame, how: str = "sum", window: int = 20, deviations: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(collapsed series with bands and flags, statistics by metric)."""
    banded = explore.bands(explore.collapse(df, how), window, deviations)
    return banded, explore.pattern_statistics(banded)


def analyze_correlations(series: DataFrame, method: str = "pearson", threshold: float = 0.7) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(coefficients, strong pairs, summary) of aligned series."""
    matrix = correlate.correlation_of_samples(series, method)
    return matrix, correlate.high_correlations(matrix, threshold), correlate.correlation_summary(matrix)


def export_metrics(raw: DataFrame, seconds: int = 60) -> DataFrame:
    """Collected range-query results as exported metrics: flattened, named, rated."""
    samples = with_container_name(io.flatten_range_queries(raw), strict=False)
    return rates.exported_metrics(samples.withColumn("container_name", F.coalesce("container_name", "container_id")), seconds)


def export_run(raw: DataFrame, path: str, stamp: str, container: str | None = None, namespace: str | None = None, hours: int = 1, seconds: int = 60, fmt: str = "csv") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Select series, export their metrics in files: (catalogue, counts by metric, rows by chunk of time).

    Chunks of ``hours`` begin at the first sample; the last sample belongs to
    the chunk that it ends.
    """
    fits = F.filter("data.result", lambda s: label_selector(s["metric"], container, namespace))
    chosen = raw.withColumn("data", F.col("data").withField("result", fits))
    found = export_metrics(chosen, seconds)
    counts = io.write_exports(found, path, fmt)
    bounds = found.agg(F.min(TIME).alias("start"), F.max(TIME).alias("end"))
    chunks = io.time_chunks(bounds, hours)
    # chunks are one row for some hours of the export
    placed = found.join(F.broadcast(bounds), how="cross").withColumn("chunk_start", F.when(F.col(TIME) < F.col("end"), F.col("start") + F.make_dt_interval(hours=(F.floor(micros_between(F.col("start"), F.col(TIME)) / (hours * 3_600_000_000)) * hours).cast("int"))))
    rows = placed.groupBy("chunk_start").agg(F.count(F.lit(1)).alias("n"))
    last = rows.filter("chunk_start is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_last"))
    by_chunk = chunks.join(rows, "chunk_start", "left").join(F.broadcast(last), how="cross").join(F.broadcast(bounds), how="cross")
    n = F.coalesce("n", F.lit(0)) + F.when(F.col("chunk_end") == F.col("end"), F.col("n_last")).otherwise(0)
    return io.metric_catalogue(found, stamp), counts, by_chunk.select("chunk_start", "chunk_end", n.alias("n_rows"))


def evaluate_forecasts(data: DataFrame, horizons: tuple[int, ...], order: tuple[int, int, int] = forecast.DEFAULT, scalers: DataFrame | None = None, path: str | None = None, seasonal: tuple[int, int, int, int] = (0, 0, 0, 0)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(by horizon, degradation, by step) of a refit on each test window.

    Scores by horizon include the directional accuracy, and are written as
    JSON to ``path`` if one is given.  Forecasts of scaled windows are scaled back; so are their targets,
    but for those kept as ``true_<h>``, which scaling and scaling back would leave a little off.

    Windows are dealt out evenly first, as fits take CPU and not data.
    """
    test = data.filter("split = 'test'").repartition(*SERIES, "window_id")
    scored = windows.per_window(test, forecast.arima_windows, horizons, many=True, order=order, seasonal=seasonal)
    if scalers is not None:
        names = {f"{side}_{h}": f"y_{h}" for h in horizons for side in ("y", "pred")}
        kept = {f"y_{h}": F.col(f"true_{h}") for h in horizons if f"true_{h}" in data.columns}
        back = [c for c in names if c not in kept]
        scored = scale.apply_scaler(scored, scalers, back, inverse=True, names=names).withColumns(kept)
    paired = evaluate.pair_steps(scored, horizons, directions=True)
    by_horizon = evaluate.horizon_analysis(paired)
    if path is not None:
        io.write_results(by_horizon, path)
    return by_horizon, evaluate.degradation(by_horizon), evaluate.step_errors(paired)


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Rows of differing inputs; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
