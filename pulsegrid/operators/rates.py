"""Rates of cumulative counters and quantiles of cumulative buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..keys import SERIES, TIME, micros_between, require_columns, same_keys, ties

#: Fixed names: exported metric -> (source metric, whether it is a counter).
EXPORTED = {
    "container_cpu_rate": ("container_cpu_usage_seconds_total", True),
    "container_memory_usage": ("container_memory_usage_bytes", False),
    "container_memory_limit": ("container_spec_memory_limit_bytes", False),
    "container_network_receive_rate": ("container_network_receive_bytes_total", True),
    "container_network_transmit_rate": ("container_network_transmit_bytes_total", True),
    "container_fs_reads_rate": ("container_fs_reads_total", True),
    "container_fs_writes_rate": ("container_fs_writes_total", True),
    "container_fs_read_bytes_rate": ("container_fs_read_bytes_total", True),
    "container_fs_write_bytes_rate": ("container_fs_write_bytes_total", True),
}


def counter_rate(df: DataFrame, seconds: int = 60) -> DataFrame:
    """Add ``rate``: increase a second over the trailing range, this sample included.

    A drop means a reset, after which the new value counts in full.  Increases
    between samples of the range are divided by the time they cover; nothing
    is extrapolated to the range's edges; one sample alone gives null.  Samples
    of one time stand in order of their event_id, if there is one, and value.

    Days (or longer blocks, of ``seconds``) are worked on each by itself: one row a block hands on the last
    value and the increase so far, and the samples in reach of the next block's range stand there, too.
    """
    require_columns(df, TIME, "value")
    keys = [k for k in SERIES if k in df.columns]
    size, reach = max(86_400, seconds) * 1_000_000, seconds * 1_000_000
    micros = micros_between(F.lit("1970-01-01").cast("timestamp_ntz"), F.col(TIME).cast("timestamp_ntz"))
    rows = df.withColumn("_us", micros).withColumn("_block", F.floor(F.col("_us") / size).cast("long"))
    order = [TIME, *ties(df), "value"]
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    grown = lambda before: F.coalesce(F.when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before), F.lit(0.0))
    place = F.struct(*order)
    ends = rows.withColumn("_own", grown(F.lag("value").over(inside))).groupBy(*keys, "_block")
    ends = ends.agg(F.sum("_own").alias("_sum"), F.min_by(F.struct("value"), place).alias("_first"), F.max_by(F.struct("value"), place).alias("_last"))
    blocks = Window.partitionBy(*keys).orderBy("_block")
    linked = ends.withColumn("_before", F.lag("_last").over(blocks))
    whole = F.col("_sum") + F.coalesce(F.when(F.col("_first.value") < F.col("_before.value"), F.col("_first.value")).otherwise(F.col("_first.value") - F.col("_before.value")), F.lit(0.0))
    handed = linked.select(*[F.col(k).alias(f"_at_{k}") for k in (*keys, "_block")], "_before", F.coalesce(F.sum(whole).over(blocks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("_sofar"))
    met = rows.join(handed, same_keys([*keys, "_block"], "_at_"))
    previous = F.when(F.row_number().over(inside) == 1, F.col("_before.value")).otherwise(F.lag("value").over(inside))
    summed = met.withColumn("_own", grown(previous)).withColumn("_sum", F.col("_sofar") + F.sum("_own").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    # running totals never fall, so of equal times the last is the greatest
    ended = summed.withColumn("_end", F.max("_sum").over(Window.partitionBy(*keys, "_block").orderBy(TIME).rangeBetween(Window.unboundedPreceding, 0)))
    # backwards in time, each range's beginning is a mark, and the last sample before the mark is the range's first one;
    # so a sample is looked at once, however many ranges it is in
    at = lambda block, us, mark: F.struct(block.alias("_in"), us.alias("_at"), F.lit(mark).alias("_mark"))
    block, us = F.col("_block"), F.col("_us")
    places = [at(block, us, False), at(block, us - reach, True)]
    near = F.when(us >= (block + 1) * size - reach, F.array(*places, at(block + 1, us, False))).otherwise(F.array(*places))
    seen = ended.withColumn("_p", F.explode(near))
    backwards = Window.partitionBy(*keys, "_p._in").orderBy(F.desc("_p._at"), "_p._mark", F.desc("_sum"))
    sample = F.when(~F.col("_p._mark"), F.struct("_us", "_sum"))
    # the first increase of the range began before the range, and is left out
    begun = seen.withColumn("_begin", F.last(sample, ignorenulls=True).over(backwards.rowsBetween(Window.unboundedPreceding, 0))).filter("_p._mark")
    covered = (F.col("_us") - F.col("_begin._us")) / 1_000_000
    return begun.withColumn("rate", F.when(covered > 0, (F.col("_end") - F.col("_begin._sum")) / covered)).select(*df.columns, "rate")


def exported_metrics(df: DataFrame, seconds: int = 60) -> DataFrame:
    """Raw counters and gauges as the exported metrics: rates, or values as they are."""
    name, counter = F.lit(None).cast("string"), F.lit(False)
    for out, (source, is_counter) in EXPORTED.items():
        name = F.when(F.col("metric_name") == source, F.lit(out)).otherwise(name)
        counter = F.when(F.col("metric_name") == source, F.lit(is_counter)).otherwise(counter)
    known = df.withColumns({"_name": name, "_counter": counter}).filter("_name is not null")
    rated = counter_rate(known, seconds)
    value = F.when(F.col("_counter"), F.col("rate")).otherwise(F.col("value"))
    return rated.withColumn("value", value).filter("value is not null").withColumn("metric_name", F.col("_name")).select(*df.columns)


def bucket_quantile(buckets: DataFrame, q: float, by: tuple[str, ...] = (TIME,)) -> DataFrame:
    """Quantile of cumulative buckets (``le``, ``count``), by linear interpolation.

    The first bucket that reaches q of the total holds the quantile; where that
    is the unbounded last bucket, its lower bound is the answer.  Null without
    samples.
    """
    require_columns(buckets, "le", "count", *by)
    w = Window.partitionBy(*by).orderBy("le")
    whole = Window.partitionBy(*by)
    rows = buckets.withColumns(
        {
            "_total": F.max("count").over(whole),
            "_low": F.coalesce(F.lag("le").over(w), F.lit(0.0)),
            "_below": F.coalesce(F.lag("count").over(w), F.lit(0.0)),
        }
    )
    wanted = q * F.col("_total")
    inside = F.col("_low") + (F.col("le") - F.col("_low")) * F.try_divide(wanted - F.col("_below"), F.col("count") - F.col("_below"))
    value = F.when(F.col("le") == float("inf"), F.col("_low")).otherwise(F.coalesce(inside, F.col("le")))
    hit = rows.filter((F.col("count") >= wanted) & (F.col("_total") > 0))
    found = hit.groupBy(*by).agg(F.min_by(value, "le").alias("quantile"))
    return buckets.select(*by).distinct().join(found, list(by), "left")
