"""Sliding windows with one or more horizons, inside one series each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..keys import SERIES, TIME, in_series, micros_between, require_columns, same_keys, ties


def numbered(df: DataFrame) -> DataFrame:
    """Add ``row_no``, 0 and up, and ``n_rows`` of the series."""
    keys = [k for k in SERIES if k in df.columns]
    counts = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn("row_no", F.row_number().over(in_series(df)) - 1).withColumn("n_rows", counts)


def numbered_by_days(df: DataFrame, mean_of: str | None = None) -> DataFrame:
    """``numbered`` for long series: rows are numbered within a day, days start at the counts of the days before.

    ``mean_of``: a column whose mean over the series is added as ``center``.
    """
    keys = [k for k in SERIES if k in df.columns]
    rows = df.withColumn("_day", F.date_trunc("DAY", TIME))
    more = {} if mean_of is None else {"center": F.sum(mean_of)}
    counts = rows.groupBy(*keys, "_day").agg(F.count(F.lit(1)).alias("_c"), *[a.alias(c) for c, a in more.items()])
    days = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    series = Window.partitionBy(*keys)
    starts = counts.select(*keys, "_day", F.coalesce(F.sum("_c").over(days), F.lit(0)).alias("_before"), F.sum("_c").over(series).alias("n_rows"), *[(F.sum(c).over(series) / F.sum("_c").over(series)).alias(c) for c in more])
    place = F.row_number().over(Window.partitionBy(*keys, "_day").orderBy(TIME, *ties(df))) - 1
    other = starts.select("n_rows", "_before", *more, *[F.col(k).alias(f"_at_{k}") for k in (*keys, "_day")])
    met = rows.withColumn("_place", place).join(other, same_keys([*keys, "_day"], "_at_"))
    return met.select(*df.columns, (F.col("_before") + F.col("_place")).alias("row_no"), "n_rows", *more)


def _anchors(window: int, horizons: tuple[int, ...], stride: int) -> Column:
    fits = F.col("row_no") + window + max(horizons) <= F.col("n_rows")
    return (F.col("row_no") % stride == 0) & fits


def sliding_windows(df: DataFrame, window: int = 240, horizons: tuple[int, ...] = (20, 60, 120), stride: int = 4, features: tuple[str, ...] = ("value",), target: str = "value", block: int = 2048) -> DataFrame:
    """One row a window: ``x`` (window values; an array for each row if there are several
    features), ``y_<h>`` (the next h targets), their first and last times, ``window_id``.

    Windows start at every ``stride``-th row of a series, as long as the
    longest horizon fits; they never leave it.  Frames count rows, not time;
    a null value keeps its place in the window as a null.
    Rows of a series are gathered in blocks of ``block`` rows and what its windows need of the next one,
    and each window is cut out of its block, so arrays are made for the anchors only.
    """
    require_columns(df, TIME, target, *features)
    keys = [k for k in SERIES if k in df.columns]
    cell = F.col(features[0]) if len(features) == 1 else F.array(*[F.col(c).cast("double") for c in features])
    halo = window + max(horizons) - 1
    size = max(block, halo + 1)
    rows = numbered(df).select(*keys, "n_rows", F.struct("row_no", F.col(TIME).alias("t"), cell.alias("x"), F.col(target).cast("double").alias("y")).alias("_c"))
    number = F.col("_c.row_no")
    own = F.floor(number / size).cast("long")
    shared = (number % size < halo) & (number >= size)
    dealt = rows.withColumn("_block", F.explode(F.when(shared, F.array(own, own - 1)).otherwise(F.array(own))))
    held = dealt.groupBy(*keys, "n_rows", "_block").agg(F.array_sort(F.collect_list("_c")).alias("_c"))
    begin = F.col("_block") * size
    first = F.ceil(begin / stride).cast("long") * stride
    last = F.least(begin + size - 1, F.col("n_rows") - window - max(horizons))
    starts = held.withColumn("_at", F.explode(F.when(first <= last, F.sequence(first, last, F.lit(stride).cast("long")))))
    s = (F.col("_at") - begin).cast("int") + 1
    times = lambda k: F.element_at("_c.t", s + k)
    out = {"window_start": times(0), "window_end": times(window - 1), "x": F.slice("_c.x", s, window)}
    for h in horizons:
        out |= {f"target_start_{h}": times(window), f"target_end_{h}": times(window + h - 1), f"y_{h}": F.slice("_c.y", s + window, h)}
    return starts.select(*keys, (F.col("_at") / stride).cast("long").alias("window_id"), *[c.alias(n) for n, c in out.items()])


def window_index(df: DataFrame, window: int, horizons: tuple[int, ...], stride: int) -> DataFrame:
    """The windows' places only: series, ``window_id``, first row and times, without arrays."""
    keys = [k for k in SERIES if k in df.columns]
    w = in_series(df)
    rows = numbered(df).withColumn("window_end", F.lead(TIME, window - 1).over(w)).filter(_anchors(window, horizons, stride))
    return rows.select(*keys, F.floor(F.col("row_no") / stride).cast("long").alias("window_id"), F.col("row_no").alias("start_row"), F.col(TIME).alias("window_start"), "window_end")


def skipped_series(df: DataFrame, window: int, horizons: tuple[int, ...]) -> DataFrame:
    """Series too short for one window, with their number of rows."""
    keys = [k for k in SERIES if k in df.columns]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") < window + max(horizons))


def require_windows(df: DataFrame, window: int, horizons: tuple[int, ...]) -> DataFrame:
    """``df`` itself; raises if every series is too short."""
    keys = [k for k in SERIES if k in df.columns]
    long_enough = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= window + max(horizons))
    if long_enough.isEmpty():
        raise ValueError(f"no series has the {window + max(horizons)} rows that a window needs")
    return df


def without_gaps(windows: DataFrame, window: int, step: int) -> DataFrame:
    """Windows whose rows follow each other at ``step`` seconds throughout."""
    span = micros_between(F.col("window_start"), F.col("window_end"))
    return windows.filter(span == (window - 1) * step * 1_000_000)


def window_blocks(df: DataFrame, window: int, horizons: tuple[int, ...], stride: int, features: tuple[str, ...], target: str = "value", block: int = 4096) -> DataFrame:
    """``sliding_windows`` for long series and many features.

    Rows are numbered day by day, and a series is cut into blocks of ``block``
    rows; the rows that windows of the block before still need are copied
    once, so no task needs a whole series (``block`` is at least a window's
    rows).  Series are told apart by their key columns, which must not be null.
    Windows are taken out of a block's Arrow arrays by row numbers; no value becomes a Python object.
    """
    return numbered_window_blocks(numbered_by_days(df), window, horizons, stride, features, target, block)


def numbered_window_blocks(df: DataFrame, window: int, horizons: tuple[int, ...], stride: int, features: tuple[str, ...], target: str = "value", block: int = 4096) -> DataFrame:
    """``window_blocks`` of rows that have ``row_no`` and ``n_rows`` already."""
    require_columns(df, TIME, "row_no", "n_rows", target, *features)
    keys = [k for k in SERIES if k in df.columns]
    halo = window + max(horizons) - 1
    size = max(block, halo + 1)
    rows = df.select(*keys, "row_no", "n_rows", TIME, F.array(*[F.col(c).cast("double") for c in features]).alias("_x"), F.col(target).cast("double").alias("_y"))
    own = F.floor(F.col("row_no") / size).cast("long")
    before = F.when((F.col("row_no") % size < halo) & (F.col("row_no") >= size), F.array(own, own - 1)).otherwise(F.array(own))
    dealt = rows.withColumn("_block", F.explode(before))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    time = types[TIME]
    schema = ", ".join([f"{k} {types[k]}" for k in keys] + ["window_id long", f"window_start {time}", f"window_end {time}", "x array<array<double>>"] + [f"y_{h} array<double>" for h in horizons])

    def cut(table: pa.Table) -> pa.Table:
        table = table.sort_by("row_no").combine_chunks()
        first = table["_block"][0].as_py() * size
        at, total = table["row_no"][0].as_py(), table["n_rows"][0].as_py()
        starts = np.arange(-(-first // stride) * stride, min(first + size, total - window - max(horizons) + 1), stride) - at

        def lists(column: str, begin: int, width: int) -> pa.Array:
            rows = (starts[:, None] + np.arange(begin, begin + width)).ravel()
            return pa.ListArray.from_arrays(pa.array(np.arange(len(starts) + 1) * width, pa.int32()), table[column].combine_chunks().take(pa.array(rows)))

        out = {k: table[k].take(pa.array(np.zeros(len(starts), dtype=np.int64))) for k in keys}
        out |= {"window_id": pa.array((starts + at) // stride, pa.int64()), "window_start": table[TIME].take(pa.array(starts)), "window_end": table[TIME].take(pa.array(starts + window - 1))}
        return pa.table(out | {"x": lists("_x", 0, window)} | {f"y_{h}": lists("_y", window, h) for h in horizons})

    return dealt.groupBy(*keys, "_block").applyInArrow(cut, schema)


def last_states(windows: DataFrame) -> DataFrame:
    """Last row of each window: the naive series that statistical fits take."""
    return windows.withColumn("last_state", F.element_at("x", -1)).drop("x")


def per_window(windows: DataFrame, forecast, horizons: tuple[int, ...], many: bool = False, **params) -> DataFrame:
    """Fit ``forecast(values, steps, **params)`` on every window, in place; add ``pred_<h>``.

    With ``many`` it takes a batch of windows, a row each of a matrix, and gives a row of steps for each.
    Shorter horizons are the beginning of the longest one's forecast.
    """
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in windows.schema.fields] + [f"pred_{h} array<double>" for h in horizons])
    steps = max(horizons)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            if not batch.num_rows:
                continue
            x = batch.column("x")
            lengths = x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = x.flatten().to_numpy(zero_copy_only=False).astype(float)
            if many and (lengths == lengths[0]).all():
                full = np.asarray(forecast(flat.reshape(len(lengths), -1), steps, **params), dtype=float)
            else:
                cut = np.split(flat, np.cumsum(lengths)[:-1])
                full = np.stack([np.asarray(forecast(v[None], steps, **params)[0] if many else forecast(v, steps, **params), dtype=float) for v in cut])
            for h in horizons:
                offsets = pa.array(np.arange(len(full) + 1) * h, pa.int32())
                batch = batch.append_column(f"pred_{h}", pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(full[:, :h]).ravel())))
            yield batch

    return windows.mapInArrow(run, fields)
