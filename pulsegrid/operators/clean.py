"""Units, regular grids, bounded fills and outlier clipping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import CPU
from ..functions.scalars import clip, no_nan
from ..keys import SERIES, TIME, add_micros, in_series, micros_between, require_columns, same_keys, ties

DAY = 86_400
MIB = 1024.0 * 1024.0


def convert_units(df: DataFrame, kind_of: dict[str, str] | None = None) -> DataFrame:
    """CPU in percent of 0 to 100, memory in MiB, disk unchanged, network in Mbit/s; none negative.

    CPU is multiplied by 100 if the greatest value of the whole selection is 1
    or less, so one aggregate of one row is broadcast.  ``kind_of`` tells the
    kind (cpu, memory, disk, network) of metrics that don't name theirs.
    """
    require_columns(df, "metric_name", "value")
    kind = F.when(F.col("metric_name") == CPU, "cpu")
    for name, what in (kind_of or {}).items():
        kind = kind.when(F.col("metric_name") == name, what)
    for part, what in (("cpu", "cpu"), ("memory", "memory"), ("_fs_", "disk"), ("disk", "disk"), ("network", "network")):
        kind = kind.when(F.col("metric_name").contains(part), what)
    rows = df.withColumn("_kind", kind)
    top = rows.filter("_kind = 'cpu'").groupBy("metric_name").agg(F.max("value").alias("_top"))
    # one row for each CPU metric name
    rows = rows.join(top, "metric_name", "left")
    value = F.col("value")
    cpu = clip(F.when(F.col("_top") <= 1.0, value * 100).otherwise(value), F.lit(0.0), F.lit(100.0))
    converted = (
        F.when(F.col("_kind") == "cpu", cpu)
        .when(F.col("_kind") == "memory", clip(value / MIB, F.lit(0.0)))
        .when(F.col("_kind") == "disk", clip(value, F.lit(0.0)))
        .when(F.col("_kind") == "network", clip(value * 8 / MIB, F.lit(0.0)))
        .otherwise(value)
    )
    return rows.withColumn("value", converted).select(*df.columns)


def bins(df: DataFrame, step: int) -> DataFrame:
    """Add ``bin``: the start of the left-closed bin of ``step`` seconds.

    Bins count from midnight of the series' first day.  Where the step divides
    a day that is any midnight, so the first day need not be looked up.
    """
    keys = [k for k in SERIES if k in df.columns]
    if DAY % step == 0:
        start = F.date_trunc("DAY", TIME).cast("timestamp_ntz")
        return df.withColumn("bin", _floor(F.col(TIME).cast("timestamp_ntz"), start, step))
    first = df.groupBy(*keys).agg(F.date_trunc("DAY", F.min(TIME)).cast("timestamp_ntz").alias("_day"))
    rows = df.join(first, keys)
    return rows.withColumn("bin", _floor(F.col(TIME).cast("timestamp_ntz"), F.col("_day"), step)).drop("_day")


def _floor(ts: Column, start: Column, step: int) -> Column:
    size = step * 1_000_000
    return add_micros(start, F.floor(micros_between(start, ts) / size) * size)


def resample(df: DataFrame, step: int = 15) -> DataFrame:
    """Mean of each bin of each series that has values (pre-aggregated, one shuffle)."""
    require_columns(df, TIME, "value")
    keys = [k for k in SERIES if k in df.columns]
    rows = bins(df.withColumn("value", no_nan(F.col("value").cast("double"))), step)
    return rows.groupBy(*keys, F.col("bin").alias(TIME)).agg(F.avg("value").alias("value"))


def fill_grid(binned: DataFrame, step: int = 15) -> DataFrame:
    """Add the empty bins between a series' first and last bin, with null values.

    Every bin makes the empty ones up to the next bin, so the grid needs no
    join and stays in the partitioning of the series.
    """
    following = F.lead(TIME).over(in_series(binned))
    last = F.coalesce(add_micros(F.col("_next"), F.lit(-step * 1_000_000)), F.col(TIME))
    slots = F.explode(F.sequence(F.col(TIME), last, F.expr(f"interval {step} seconds")))
    rows = binned.withColumn("_next", following).withColumn("_slot", slots)
    value = F.when(F.col("_slot") == F.col(TIME), F.col("value"))
    return rows.withColumn("value", value).withColumn(TIME, F.col("_slot")).select(*binned.columns)


def fill_limited(df: DataFrame, limit: int = 3) -> DataFrame:
    """Carry values forward over ``limit`` empty bins at most, then backward over as many."""
    w = in_series(df)
    ahead = df.withColumn("value", F.last("value", ignorenulls=True).over(w.rowsBetween(-limit, 0)))
    return ahead.withColumn("value", F.first("value", ignorenulls=True).over(w.rowsBetween(0, limit)))


def fill_unlimited(df: DataFrame) -> DataFrame:
    """Carry values forward, then backward, without a limit.

    Days are filled on their own; what a day begins or ends with comes from one row a day of each series,
    so no task goes through a whole series.
    """
    keys = [k for k in SERIES if k in df.columns]
    order = F.struct(TIME, *ties(df))
    rows = df.withColumn("_day", F.date_trunc("DAY", TIME))
    there = F.when(F.col("value").isNotNull(), order)
    ends = rows.groupBy(*keys, "_day").agg(F.min_by("value", there).alias("_first"), F.max_by("value", there).alias("_last"))
    days = Window.partitionBy(*keys).orderBy("_day")
    carried = ends.select(
        *[F.col(k).alias(f"_at_{k}") for k in (*keys, "_day")],
        F.last("_last", ignorenulls=True).over(days.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first("_first", ignorenulls=True).over(days.rowsBetween(1, Window.unboundedFollowing)).alias("_after"),
    )
    met = rows.join(carried, same_keys(keys + ["_day"], "_at_"))
    day = Window.partitionBy(*keys, "_day").orderBy(TIME, *ties(df))
    back = F.last("value", ignorenulls=True).over(day.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first("value", ignorenulls=True).over(day.rowsBetween(0, Window.unboundedFollowing))
    return met.withColumn("_value", F.coalesce(back, "_before", ahead, "_after")).select(*[F.col("_value").alias(c) if c == "value" else c for c in df.columns])


def regular_grid(df: DataFrame, step: int = 15, limit: int = 3) -> DataFrame:
    """Resample, add empty bins and fill them; what a longer gap leaves empty stays null."""
    return fill_limited(fill_grid(resample(df, step), step), limit)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without a null in any column."""
    return df.dropna(how="any")


def clip_outliers(df: DataFrame, threshold: float | None = 3.0) -> DataFrame:
    """Clip each series to its mean ± ``threshold`` sample deviations, and to 0 below.

    Series without a spread stay; None turns clipping off.  The statistics are
    one pre-aggregated row a series, so a very long series is not buffered.
    """
    if threshold is None:
        return df
    keys = [k for k in SERIES if k in df.columns]
    stats = df.groupBy(*keys).agg(F.avg("value").alias("_mean"), F.stddev_samp("value").alias("_std"))
    rows = df.join(stats, keys)
    spread = threshold * F.col("_std")
    clipped = clip(F.col("value"), F.greatest(F.lit(0.0), F.col("_mean") - spread), F.col("_mean") + spread)
    return rows.withColumn("value", F.when(F.col("_std") > 0, clipped).otherwise(F.col("value"))).select(*df.columns)
