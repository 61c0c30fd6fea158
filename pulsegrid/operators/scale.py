"""Scalers as small tables of (feature, center, scale)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..keys import require_columns
from .quantiles import quantiles

METHODS = ("minmax", "standard", "robust")


def _center_scale(value: Column, method: str, weight: Column | None = None) -> tuple[Column, Column]:
    """Aggregates of a column; with a weight, as if every row stood there that often."""
    if method == "minmax":
        seen = value if weight is None else F.when(weight > 0, value)
        return F.min(seen), F.max(seen) - F.min(seen)
    if method == "standard":
        if weight is None:
            return F.avg(value), F.stddev_pop(value)
        n = F.sum(F.when(value.isNotNull(), weight))
        mean = F.sum(value * weight) / n
        return mean, F.sqrt(F.greatest(F.sum(value * value * weight) / n - mean * mean, F.lit(0.0)))
    raise ValueError(f"unknown method: {method}; one of {METHODS}")


def _robust(cells: DataFrame, weight: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., center, scale) of the column ``v``: median and spread of the quartiles, exact, in bounded memory."""
    q = quantiles(cells, "v", (0.25, 0.5, 0.75), by, weight)
    spread = F.col("q")[2] - F.col("q")[0]
    return q.select(*by, F.col("q")[1].alias("center"), F.when(spread == 0, 1.0).otherwise(spread).alias("scale"))


def fit_scaler(df: DataFrame, columns: list[str], method: str = "standard", weight: str | None = None) -> DataFrame:
    """(feature, center, scale) over the given rows, which should be the training rows only.

    A spread of zero scales by 1.  ``weight``: an integer column that tells
    how many windows hold the row, instead of exploding the windows.
    """
    require_columns(df, *columns)
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}; one of {METHODS}")
    if method == "robust":
        fits = [_robust(df.select(F.col(c).cast("double").alias("v"), *([F.col(weight).alias("w")] if weight else [])), "w" if weight else None).withColumn("feature", F.lit(c)) for c in columns]
        named = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")  # also those without a value
        return named.join(reduce(DataFrame.unionByName, fits), "feature", "left").select("feature", "center", "scale")
    aggs = []
    for i, c in enumerate(columns):
        center, scale = _center_scale(F.col(c).cast("double"), method, F.col(weight).cast("long") if weight else None)
        aggs += [center.alias(f"c{i}"), scale.alias(f"s{i}")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("center"), F.col(f"s{i}").alias("scale")) for i, c in enumerate(columns)]))
    return one.select(rows.alias("r")).select("r.feature", "r.center", F.when(F.col("r.scale") == 0, 1.0).otherwise(F.col("r.scale")).alias("scale"))


def fit_target_scalers(windows: DataFrame, horizons: tuple[int, ...], method: str = "standard") -> DataFrame:
    """One row a horizon, over all steps of the training windows' targets."""
    fits = [fit_scaler(windows.select(F.explode(f"y_{h}").alias(f"y_{h}")), [f"y_{h}"], method) for h in horizons]
    return reduce(DataFrame.unionByName, fits)


def fit_input_scalers(windows: DataFrame, method: str = "standard") -> DataFrame:
    """One row a feature, ``x_0``, ``x_1``, ..., over all rows of the training windows' inputs.

    A row counts as often as windows hold it.  Plain windows have one feature.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}; one of {METHODS}")
    rows = windows.select(F.explode("x").alias("r"))
    nested = dict(windows.dtypes)["x"].startswith("array<array")
    cells = rows.select(F.posexplode("r" if nested else F.array("r")).alias("i", "v"))
    if method == "robust":
        return _robust(cells, by=("i",)).select(F.concat(F.lit("x_"), "i").alias("feature"), "center", "scale")
    center, spread = _center_scale(F.col("v").cast("double"), method)
    out = cells.groupBy("i").agg(center.alias("center"), spread.alias("scale"))
    return out.select(F.concat(F.lit("x_"), "i").alias("feature"), "center", F.when(F.col("scale") == 0, 1.0).otherwise(F.col("scale")).alias("scale"))


def apply_input_scaler(windows: DataFrame, scaler: DataFrame, inverse: bool = False) -> DataFrame:
    """Scale ``x`` feature by feature, or scale it back; the scaler is one broadcast row of a cell a feature."""
    place = F.regexp_extract("feature", r"^x_(\d+)$", 1)
    one = scaler.filter(place != "").agg(F.array_sort(F.collect_list(F.struct(place.cast("int").alias("i"), "center", "scale"))).alias("_s"))
    nested = dict(windows.dtypes)["x"].startswith("array<array")
    missing = F.raise_error(F.lit("Scaler not fitted for all columns")).cast("struct<i:int,center:double,scale:double>")

    def row(v: Column) -> Column:
        cells = F.transform(v if nested else F.array(v), lambda cell, i: _scaled(cell, F.coalesce(F.get("_s", i), missing), inverse, False))
        return cells if nested else cells[0]

    return windows.crossJoin(F.broadcast(one)).withColumn("x", F.transform("x", row)).select(*windows.columns)


def _stats(scaler: DataFrame, columns: list[str]) -> DataFrame:
    """The scaler as one row; raises if it was not fitted for a column."""
    picked = [F.max(F.when(F.col("feature") == c, F.struct("center", "scale"))).alias(f"_s{i}") for i, c in enumerate(columns)]
    one = scaler.agg(*picked)
    missing = F.raise_error(F.lit("Scaler not fitted for all columns")).cast("struct<center:double,scale:double>")
    return one.select(*[F.coalesce(f"_s{i}", missing).alias(f"_s{i}") for i in range(len(columns))])


def apply_scaler(df: DataFrame, scaler: DataFrame | None, columns: list[str], inverse: bool = False, names: dict[str, str] | None = None) -> DataFrame:
    """Scale the columns, or scale them back; arrays are scaled element by element.

    ``names`` maps a column to the scaler's feature where they differ.  The
    scaler has one row a feature, so one broadcast row serves all rows.
    """
    if scaler is None:
        raise ValueError("Scaler not fitted")
    require_columns(df, *columns)
    joined = df.crossJoin(F.broadcast(_stats(scaler, [(names or {}).get(c, c) for c in columns])))
    types = dict(df.dtypes)
    return joined.withColumns({c: _scaled(F.col(c), F.col(f"_s{i}"), inverse, types[c].startswith("array")) for i, c in enumerate(columns)}).select(*df.columns)


def _scaled(value: Column, stats: Column, inverse: bool, array: bool) -> Column:
    def one(v: Column) -> Column:
        return v * stats["scale"] + stats["center"] if inverse else (v - stats["center"]) / stats["scale"]

    return F.transform(value, one) if array else one(value)


def fit_apply(train: DataFrame, others: list[DataFrame], columns: list[str], method: str = "standard") -> tuple[DataFrame, list[DataFrame]]:
    """Fit on ``train`` alone and scale it and the others."""
    scaler = fit_scaler(train, columns, method)
    return scaler, [apply_scaler(d, scaler, columns) for d in (train, *others)]
