"""Column names of the data model and the windows over a series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SERIES = ("metric_name", "container_name")
TIME = "timestamp"


def require_columns(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"DataFrame must have columns {missing}")


def ties(df: DataFrame) -> list[str]:
    """What orders rows of one time: event_id, where there is one."""
    return ["event_id"] if "event_id" in df.columns else []


def in_series(df: DataFrame, order: str = TIME) -> WindowSpec:
    """The rows of a series in time order; a tie is broken by event_id, where there is one."""
    return Window.partitionBy(*[k for k in SERIES if k in df.columns]).orderBy(order, *ties(df))


def same_keys(keys: list[str], prefix: str) -> Column:
    """Equal keys, where the other side's names have a prefix; null is a key, too."""
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys], F.lit(True))


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def add_micros(ts: Column, n: Column) -> Column:
    return F.timestamp_add("MICROSECOND", n, ts)
