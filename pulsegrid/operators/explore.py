"""Profiles: duplicates, missing values, percentiles, bands, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..keys import TIME, in_series, require_columns
from .quantiles import met_by, quantiles

#: Fixed names: how duplicate samples of each metric are joined.
STRATEGIES = {"default": "max"}
NAMED = {"sum": F.sum, "mean": F.avg, "avg": F.avg, "max": F.max, "min": F.min, "count": F.count, "median": F.median}


def named_aggregate(name: str, column: str) -> Column:
    if name not in NAMED:
        raise ValueError(f"unknown aggregate: {name}")
    return NAMED[name](column)


def duplicate_counts(df: DataFrame) -> DataFrame:
    """Rows for each metric, time and container id."""
    return df.groupBy("metric_name", TIME, "container_id").agg(F.count(F.lit(1)).alias("n"))


def duplicate_profile(df: DataFrame) -> DataFrame:
    """By metric: least, greatest and mean count, and the first key with the greatest."""
    counts = duplicate_counts(df)
    first = F.min_by(F.struct(TIME, "container_id"), F.struct(-F.col("n"), TIME, "container_id"))
    out = counts.groupBy("metric_name").agg(F.min("n").alias("min_count"), F.max("n").alias("max_count"), F.avg("n").alias("mean_count"), first.alias("w"))
    return out.select("metric_name", "min_count", "max_count", "mean_count", F.col(f"w.{TIME}").alias("worst_timestamp"), F.col("w.container_id").alias("worst_container_id"))


def worst_duplicates(df: DataFrame) -> DataFrame:
    """The rows of each metric's most repeated key."""
    worst = duplicate_profile(df).select("metric_name", F.col("worst_timestamp").alias(TIME), F.col("worst_container_id").alias("container_id"))
    # one key a metric
    return df.join(worst, ["metric_name", TIME, "container_id"], "left_semi")


def deduplicate(df: DataFrame, strategy: dict[str, str] | None = None) -> DataFrame:
    """One row for each metric, time and container id, joined as the strategy says."""
    plan = STRATEGIES | (strategy or {})
    value = F.when(F.lit(False), F.lit(0.0))
    names = sorted({*plan.values()})
    out = df.groupBy("metric_name", TIME, "container_id").agg(*[named_aggregate(n, "value").alias(f"_{n}") for n in names])
    for metric, name in plan.items():
        if metric != "default":
            value = value.when(F.col("metric_name") == metric, F.col(f"_{name}"))
    return out.select("metric_name", TIME, "container_id", value.otherwise(F.col(f"_{plan['default']}")).alias("value"))


def cluster_statistics(deduplicated: DataFrame, approximate: bool = False, wide: bool = False) -> DataFrame:
    """By metric and time: mean, least, greatest, and percentiles over the containers.

    Exact percentiles keep the distinct values of one time only; ``wide`` narrows
    ranges of values instead, for clusters of millions of containers, and
    ``approximate`` takes a sketch of bounded error (one in 10,000 ranks).
    """
    shares = (0.25, 0.5, 0.75, 0.95, 0.99)
    if wide and not approximate:
        plain = deduplicated.groupBy("metric_name", TIME).agg(F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"))
        out = met_by(plain, quantiles(deduplicated, "value", shares, ("metric_name", TIME)), ("metric_name", TIME))
        return out.select("metric_name", TIME, "mean", "min", "max", *[F.col("q")[i].alias(f"p{round(100 * s)}") for i, s in enumerate(shares)])
    q = (F.percentile_approx if approximate else F.percentile)("value", F.array(*[F.lit(s) for s in shares]))
    out = deduplicated.groupBy("metric_name", TIME).agg(F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"), q.alias("q"))
    return out.select("metric_name", TIME, "mean", "min", "max", *[F.col("q")[i].alias(f"p{round(100 * s)}") for i, s in enumerate(shares)])


def dataset_summary(df: DataFrame) -> DataFrame:
    """By metric: rows, number of columns, column list."""
    return df.groupBy("metric_name").agg(F.count(F.lit(1)).alias("n_rows")).withColumns({"n_columns": F.lit(len(df.columns)), "columns": F.lit(",".join(df.columns))})


def describe(df: DataFrame, column: str = "value", by: tuple[str, ...] = ("metric_name",)) -> DataFrame:
    """Count, mean, sample deviation, least, quartiles, greatest.

    Quartiles are exact and found by narrowing, so no task keeps a whole
    group's values (a job when it is called tells whether groups are large).
    """
    plain = df.groupBy(*by).agg(F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.min(column).alias("min"), F.max(column).alias("max"))
    out = met_by(plain, quantiles(df, column, (0.25, 0.5, 0.75), by), by)
    return out.select(*by, "count", "mean", "std", "min", *[F.col("q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))], "max")


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with nulls: their count and percentage, most first."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    long = counts.unpivot("_n", list(df.columns), "column", "n_missing")
    return long.filter("n_missing > 0").select("column", "n_missing", (100.0 * F.col("n_missing") / F.col("_n")).alias("percent")).orderBy(F.desc("n_missing"), "column")


def collapse(df: DataFrame, how: str = "sum") -> DataFrame:
    """One value for each metric and time over all containers."""
    return df.groupBy("metric_name", TIME).agg(named_aggregate(how, "value").alias("value"))


def bands(df: DataFrame, window: int = 20, deviations: float = 2.0) -> DataFrame:
    """Add the centred mean and deviation, the bands, and spike, dip and anomaly flags.

    Rows without a full window have null bands and false flags.  Meant for
    collapsed series, of one row a time.
    """
    w = in_series(df).rowsBetween(-(window // 2), window - 1 - window // 2)
    full = F.count(F.lit(1)).over(w) == window
    rows = df.withColumn("band_mean", F.when(full, F.avg("value").over(w))).withColumn("band_std", F.when(full, F.stddev_samp("value").over(w)))
    spread = deviations * F.col("band_std")
    rows = rows.withColumns({"upper": F.col("band_mean") + spread, "lower": F.col("band_mean") - spread})
    flags = {"spike": F.coalesce(F.col("value") > F.col("upper"), F.lit(False)), "dip": F.coalesce(F.col("value") < F.col("lower"), F.lit(False))}
    return rows.withColumns(flags).withColumn("anomaly", F.col("spike") | F.col("dip"))


def pattern_statistics(banded: DataFrame) -> DataFrame:
    """By metric: counts of flags, anomaly rate in percent, mean, deviation, cv and range."""
    out = banded.groupBy("metric_name").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("spike").alias("spikes"),
        F.count_if("dip").alias("dips"),
        F.count_if("anomaly").alias("anomalies"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return out.withColumns({"anomaly_rate": 100.0 * F.col("anomalies") / F.col("total"), "cv": F.try_divide("std", "mean")})


def range_summary(df: DataFrame) -> DataFrame:
    """By series: rows, range of values, range of times."""
    require_columns(df, "metric_name", "container_name", TIME, "value")
    return df.groupBy("metric_name", "container_name").agg(F.count(F.lit(1)).alias("n_rows"), F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.min(TIME).alias("first_timestamp"), F.max(TIME).alias("last_timestamp"))
