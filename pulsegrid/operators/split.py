"""Splits by time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..keys import SERIES
from .order import sums_before


def check_ratios(train: float, validation: float, test: float) -> None:
    if abs(train + validation + test - 1.0) > 1e-6:
        raise ValueError("ratios must sum to 1")


def temporal_split(df: DataFrame, order: str, train: float = 0.7, validation: float = 0.15, test: float = 0.15, scope: str = "series") -> DataFrame:
    """Add ``split``: the first rows train, the next validate, the rest test; nothing is shuffled.

    ``scope`` "series" splits every series by itself; "global" splits the rows
    as they stand in order of their series.  For the latter, counts a series
    give its offset, summed range by range, so neither rows nor series are
    ever numbered by one task.
    """
    check_ratios(train, validation, test)
    keys = [k for k in SERIES if k in df.columns]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    rows = df.withColumn("_place", place)
    if scope == "series":
        rows = rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    elif scope == "global":
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
        offsets = sums_before(counts, keys, F.col("_c")).withColumnRenamed("_total", "_n")
        rows = rows.join(offsets.drop("_c"), keys).withColumn("_place", F.col("_place") + F.col("_before")).drop("_before")
    else:
        raise ValueError("scope must be 'series' or 'global'")
    first, second = F.floor(F.col("_n") * F.lit(float(train))), F.floor(F.col("_n") * F.lit(float(train + validation)))
    split = F.when(F.col("_place") < first, "train").when(F.col("_place") < second, "validation").otherwise("test")
    return rows.withColumn("split", split).drop("_place", "_n")


def split_sizes(split: DataFrame) -> DataFrame:
    """Rows of each part and the index at which it ends, by series."""
    keys = [k for k in SERIES if k in split.columns]
    counts = {f"n_{s}": F.count_if(F.col("split") == s) for s in ("train", "validation", "test")}
    out = split.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_total"), *[c.alias(n) for n, c in counts.items()])
    return out.withColumns({"train_end": F.col("n_train"), "validation_end": F.col("n_train") + F.col("n_validation")})


def container_shares(split: DataFrame, part: str = "train") -> DataFrame:
    """Windows of each container in one part, and their percentage of all."""
    counts = split.filter(F.col("split") == part).groupBy("container_name").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return counts.crossJoin(F.broadcast(total)).select("container_name", "n", (100.0 * F.col("n") / F.col("_total")).alias("percent"))
