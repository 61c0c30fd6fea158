"""Sums and numbers along an order, without one task for all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCKS = 64


def sums_before(df: DataFrame, order: list[str], weight: Column, blocks: int = BLOCKS) -> DataFrame:
    """Add ``_before``, the sum of ``weight`` over the rows before in order, and ``_total``.

    Rows are dealt into ranges between the order columns of ``blocks`` rows
    (those of the smallest hashes, the only ones that reach the driver); sums
    of the ranges, ``blocks`` + 1 rows, give each range its offset.
    """
    at = F.struct(*[F.col(c) for c in order])
    ends = [r.at for r in df.select(at.alias("at")).orderBy(F.xxhash64(*order), *order).limit(blocks).collect()]
    kind = df.select(at.alias("at")).schema["at"].dataType
    bounds = df.sparkSession.createDataFrame([(ends,)], f"_bounds array<{kind.simpleString()}>")
    rows = df.crossJoin(F.broadcast(bounds)).withColumn("_range", F.size(F.filter("_bounds", lambda b: b <= at))).drop("_bounds")
    rows = rows.withColumn("_weight", weight)
    sums = rows.groupBy("_range").agg(F.sum("_weight").alias("_s"))
    ranges = sums.select("_range", F.coalesce(F.sum("_s").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"), F.sum("_s").over(Window.partitionBy()).alias("_total"))
    own = F.coalesce(F.sum("_weight").over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("_own", own).join(F.broadcast(ranges), "_range").select(*df.columns, (F.col("_offset") + F.col("_own")).alias("_before"), "_total")
