"""Live resampling, rates and alerts.

Watermarks need timestamps with a zone, so event times are cast first (the
session's zone is UTC).  In append mode a window is emitted once the watermark
has passed its end; windows newer than that stay open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.scalars import no_nan
from ..keys import SERIES, TIME


def read_samples(spark: SparkSession, path: str, schema: str, name_filter: str | None = None) -> DataFrame:
    """A stream over Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema)
    return (reader.option("pathGlobFilter", name_filter) if name_filter else reader).parquet(path)


def _timed(samples: DataFrame, late: str) -> DataFrame:
    rows = samples.withColumn(TIME, F.col(TIME).cast("timestamp")).withColumn("value", no_nan(F.col("value").cast("double")))
    return rows.withWatermark(TIME, late)


def _by_window(samples: DataFrame, late: str, window: Column, **aggs: Column) -> DataFrame:
    out = _timed(samples, late).groupBy(window.alias("w"), *SERIES).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(*SERIES, F.col("w.start").cast("timestamp_ntz").alias(TIME), F.col("w.end").cast("timestamp_ntz").alias("window_end"), *aggs)


def live_resample(samples: DataFrame, step: str = "15 seconds", late: str = "1 minute") -> DataFrame:
    """Mean of each tumbling window of each series, without fills."""
    return _by_window(samples, late, F.window(TIME, step), value=F.avg("value")).drop("window_end")


def live_rates(samples: DataFrame, window: str = "1 minute", slide: str = "15 seconds", late: str = "1 minute") -> DataFrame:
    """Sliding windows: mean and greatest of gauges, and (max - min) / span of what only grows.

    Resets are not seen here; ``live_counter_rates`` sees them.
    """
    span = (F.unix_micros(F.max(TIME)) - F.unix_micros(F.min(TIME))) / 1e6
    return _by_window(samples, late, F.window(TIME, window, slide), mean=F.avg("value"), max=F.max("value"), rate=F.try_divide(F.max("value") - F.min("value"), span))


class _Series:
    """A counter's state: samples that wait for the watermark, and what the trailing range needs of closed ones.

    ``waiting``: (micros, id, value); ``closed``: (micros, increase up to then), the first of each time
    and the last one; ``last`` value and total increase so far.
    """

    SCHEMA = "wait_us array<long>, wait_id array<long>, wait_value array<double>, us array<long>, sums array<double>, last double, total double"
    KINDS = (np.int64, np.int64, float, np.int64, float)

    def __init__(self, held: tuple | None) -> None:
        *columns, self.last, self.total = held or ((), (), (), (), (), None, 0.0)
        columns = [np.asarray(c, dtype=k) for c, k in zip(columns, self.KINDS, strict=True)]
        self.waiting, self.closed = columns[:3], columns[3:]

    def held(self) -> tuple:
        return (*[c.tolist() for c in (*self.waiting, *self.closed)], self.last, self.total)

    def add(self, *columns: np.ndarray) -> None:
        self.waiting = [np.concatenate([a, b]) for a, b in zip(self.waiting, columns, strict=True)]

    def close(self, before: int, span: int, idle: int) -> dict[str, np.ndarray]:
        """(_us, event_id, value, rate) of the waiting samples before a time, in order; each is looked at once."""
        self.waiting = [c[np.lexsort(self.waiting[::-1])] for c in self.waiting]
        n = int(np.searchsorted(self.waiting[0], before))
        us, ids, value = (c[:n] for c in self.waiting)
        self.waiting = [c[n:] for c in self.waiting]
        if not n:
            return {"_us": us, "event_id": ids, "value": value, "rate": value}
        held_us, held_sums = self.closed
        # a silence begins anew: nothing before it is in reach or grown from
        anew = np.diff(us, prepend=held_us[-1] if len(held_us) else us[0]) > idle
        past = np.concatenate([[value[0] if self.last is None else self.last], value[:-1]])
        grown = np.where(anew, 0.0, np.where(value < past, value, value - past))
        if self.last is None:
            grown[0] = 0.0
        sums = np.cumsum(np.concatenate([[self.total], grown]))[1:]
        first = np.flatnonzero(np.diff(us, prepend=us[0] - 1))
        of = np.cumsum(np.diff(us, prepend=us[0] - 1) > 0) - 1
        times, totals = np.concatenate([held_us, us[first]]), np.concatenate([held_sums, sums[first]])
        own = len(held_us) + np.arange(len(first))
        begin = np.maximum(np.searchsorted(times, us[first] - span), np.maximum.accumulate(np.where(anew[first], own, 0)))
        covered = (us[first] - times[begin]) / 1_000_000
        ends = sums[np.append(first[1:], n) - 1]
        rate = np.divide(ends - totals[begin], covered, out=np.full(len(first), np.nan), where=covered > 0)
        self.closed, self.last, self.total = [times[begin[-1] :], totals[begin[-1] :]], float(value[-1]), float(sums[-1])
        return {"_us": us, "event_id": ids, "value": value, "rate": rate[of]}


def live_counter_rates(samples: DataFrame, seconds: int = 60, late: str = "1 minute", forget: str = "1 day") -> DataFrame:
    """(series, timestamp, event_id, value, rate): ``counter_rate`` of every sample, once the watermark has passed it.

    Resets are seen; samples may come in any order within ``late``, later ones are dropped.  A series'
    state is its samples of that time and of the trailing range, its last value and its total increase;
    it stands in the stream's checkpoint, so a restart goes on where it was.  A series silent for
    ``forget`` starts anew.  Samples of one time stand in order of their ``event_id``, if there is one,
    and value.  Null values are left out; keys may be null.
    """
    tie = F.col("event_id").cast("long") if "event_id" in samples.columns else F.lit(0).cast("long")
    rows = _timed(samples.withColumn("_id", tie), late).filter("value is not null").select(*SERIES, TIME, F.unix_micros(TIME).alias("_us"), "_id", "value")
    span, idle = seconds * 1_000_000, int(pd.Timedelta(forget).total_seconds() * 1000)

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mine = _Series(state.get if state.exists else None)
        for pdf in parts:
            mine.add(pdf["_us"].to_numpy(np.int64), pdf["_id"].fillna(-1).to_numpy(np.int64), pdf["value"].to_numpy(float))
        mark = max(state.getCurrentWatermarkMs(), 0)
        done = mine.close(mark * 1000, span, idle * 1000)
        waiting, closed = mine.waiting[0], mine.closed[0]
        if state.hasTimedOut and not len(done["_us"]) and not len(waiting):
            state.remove()
        else:
            state.update(mine.held())
            due = int(waiting[0]) // 1000 if len(waiting) else int(closed[-1]) // 1000 + idle
            state.setTimeoutTimestamp(max(due, mark + 1))
        if len(done["_us"]):
            yield pd.DataFrame(done).astype({"rate": "Float64"}).assign(metric_name=key[0], container_name=key[1])

    out = rows.groupBy(*SERIES).applyInPandasWithState(run, "metric_name string, container_name string, _us long, event_id long, value double, rate double", _Series.SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(*SERIES, F.timestamp_micros("_us").cast("timestamp_ntz").alias(TIME), "event_id", "value", "rate")


def live_alerts(resampled: DataFrame, stats: DataFrame, deviations: float = 2.0) -> DataFrame:
    """Windows beyond mean ± ``deviations`` of their series' fitted (mean, std)."""
    joined = resampled.join(stats, list(SERIES))
    spread = deviations * F.col("std")
    flags = joined.withColumns({"spike": F.col("value") > F.col("mean") + spread, "dip": F.col("value") < F.col("mean") - spread})
    return flags.filter("spike or dip").drop("mean", "std")


def run_available(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Process what is there, as Parquet (exactly once), and read it back."""
    spark = stream.sparkSession
    query = stream.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
