"""Calendar, lag and rolling features of a series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import calendar
from ..keys import TIME, in_series

#: The lags and the windows of the rolling features, in rows.
LAGS = (1, 4, 12, 24)
ROLLS = (4, 12, 24, 60)
NOT_FEATURES = (TIME, "value", "container_name", "container_id", "metric_name")


def add_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar(F.col(TIME)))


def add_lags(df: DataFrame, column: str = "value", lags: tuple[int, ...] = LAGS) -> DataFrame:
    """``<column>_lag_<k>``: the value k rows back in the same series."""
    w = in_series(df)
    return df.withColumns({f"{column}_lag_{k}": F.lag(column, k).over(w) for k in lags})


def add_rolling(df: DataFrame, column: str = "value", windows: tuple[int, ...] = ROLLS) -> DataFrame:
    """Mean, sample deviation, least and greatest of the last w rows, this one included.

    All windows share one partitioning and order, so Spark sorts once.
    """
    out = {}
    for size in windows:
        w = in_series(df).rowsBetween(1 - size, 0)
        for name, f in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max)):
            out[f"{column}_roll_{name}_{size}"] = f(column).over(w)
    return df.withColumns(out)


def add_features(df: DataFrame, column: str = "value", with_calendar: bool = True, with_lags: bool = True, with_rolling: bool = True, lags: tuple[int, ...] = LAGS, windows: tuple[int, ...] = ROLLS) -> DataFrame:
    """All families that are switched on, less the rows that lack a feature."""
    out = add_calendar(df) if with_calendar else df
    out = add_lags(out, column, lags) if with_lags else out
    out = add_rolling(out, column, windows) if with_rolling else out
    return out.dropna(how="any")


def feature_columns(df: DataFrame) -> list[str]:
    """Every column that is no key, time or value; ``["value"]`` if none is left."""
    return [c for c in df.columns if c not in NOT_FEATURES] or ["value"]
