"""Correlation of many series."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..keys import TIME, require_columns
from ..sources.io import write_frame
from .clean import fill_unlimited
from .order import sums_before


def named_series(df: DataFrame) -> DataFrame:
    """(series, timestamp, value): the series' name is its metric and container."""
    return df.select(F.concat_ws("/", "metric_name", "container_name").alias("series"), TIME, "value")


def align(series: DataFrame) -> DataFrame:
    """Every series at every time of any: gaps filled forward, then backward.

    The names, one row a series, are paired with the distinct times by a
    join without a broadcast hint, so Spark chooses by their sizes.
    """
    require_columns(series, "series", TIME, "value")
    one = series.groupBy("series", TIME).agg(F.avg("value").alias("value"))
    times, names = one.select(TIME).distinct(), one.select("series").distinct()
    grid = times.crossJoin(names).join(one, ["series", TIME], "left")
    return fill_unlimited(grid.withColumnRenamed("series", "container_name")).withColumnRenamed("container_name", "series")


def ranked(aligned: DataFrame) -> DataFrame:
    """Values as average ranks within their series; ties share the mean of their ranks."""
    order = Window.partitionBy("series").orderBy("value")
    ties = F.count(F.lit(1)).over(Window.partitionBy("series", "value"))
    return aligned.withColumn("value", F.rank().over(order) + (ties - 1) / 2.0)


def pairs(aligned: DataFrame) -> DataFrame:
    """Pairs of different series at the same time, (a, b) with a < b."""
    left = aligned.select(F.col("series").alias("series_a"), TIME, F.col("value").alias("x"))
    right = aligned.select(F.col("series").alias("series_b"), TIME, F.col("value").alias("y"))
    return left.join(right, TIME).filter("series_a < series_b")


#: Series of a block, about, and times of a chunk: a row holds the values of a block over a chunk, 8 MB, and a
#: group two of them, however many series and times there are.
WIDTH, TIMES = 500, 2_000


def _vectors(aligned: DataFrame, blocks: int, chunks: int) -> DataFrame:
    """(chunk, block, names, values): what each series is off its mean, a time after the other, series in order of the names."""
    means = aligned.groupBy("series").agg(F.avg("value").alias("_mean"))
    off = aligned.join(means, "series").select("series", TIME, (F.col("value") - F.col("_mean")).alias("v"))
    block = F.pmod(F.xxhash64("series"), F.lit(blocks)).cast("int").alias("block")
    chunk = F.pmod(F.xxhash64(TIME), F.lit(chunks)).cast("long").alias("chunk")
    rows = off.groupBy(TIME, chunk, block).agg(F.array_sort(F.collect_list(F.struct("series", "v"))).alias("c"))
    whole = rows.groupBy("chunk", "block").agg(F.first("c.series").alias("names"), F.array_sort(F.collect_list(F.struct(TIME, F.col("c.v").alias("v")))).alias("t"))
    return whole.select("chunk", "block", "names", F.flatten("t.v").alias("values"))


def pearson(aligned: DataFrame, width: int = WIDTH, times: int = TIMES) -> DataFrame:
    """(series_a, series_b, r); null where a series does not vary.

    Series are dealt into blocks of about ``width``, times into chunks of about ``times`` (a job counts them
    when this is called).  Two blocks of a chunk are a group, whose sums of products are one matrix product;
    only where there are several chunks are these sums, one row a pair and chunk, shuffled.
    Every series has a value at every time, as ``align`` leaves it; times where
    one has none are left out for its pairs.
    """
    blocks, chunks = (_parts(aligned, c, n) for c, n in (("series", width), (TIME, times)))

    def stack(rows: pa.Table, k: int, n: int) -> np.ndarray:
        return rows["values"][k].values.to_numpy(zero_copy_only=False).astype(float).reshape(-1, n)

    return _products(_vectors(aligned, blocks, chunks), blocks, chunks, stack)


def _parts(rows: DataFrame, column: str, size: int) -> int:
    return max(1, -(-rows.select(column).distinct().count() // size))


def _products(rows: DataFrame, blocks: int, chunks: int, matrix) -> DataFrame:
    """(series_a, series_b, r) from one row for each chunk and block: names, and what ``matrix`` needs.

    ``matrix(rows, k, series)`` makes a matrix of times by series out of row k.
    """
    # each row goes to all pairs of its block; a group is two rows, or one for a block with itself
    of = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_of")
    met = rows.select("*", of).withColumns({"_one": F.least("block", "_of"), "_two": F.greatest("block", "_of")}).drop("_of")

    def sums(g: pa.Table) -> pa.Table:
        order = np.argsort(g["block"].to_numpy())
        names = [g["names"][int(k)].values for k in (order[0], order[-1])]
        made = [matrix(g, int(k), len(n)) for k, n in zip(order, names, strict=False)]
        x, y = made[0], made[-1]
        u, v = ~np.isnan(x), ~np.isnan(y)
        x, y, u, v = np.where(u, x, 0), np.where(v, y, 0), u.astype(float), v.astype(float)
        new = [u.T @ v, x.T @ v, u.T @ y, x.T @ y, (x * x).T @ v, u.T @ (y * y)]
        i, j = np.nonzero(np.triu(np.ones(new[0].shape, dtype=bool), 1) if len(order) == 1 else np.ones(new[0].shape, dtype=bool))
        return pa.table({"a": names[0].take(pa.array(i)), "b": names[1].take(pa.array(j))} | {f"s{k}": m[i, j] for k, m in enumerate(new)})

    found = met.groupBy("_one", "_two", "chunk").applyInArrow(sums, "a string, b string, " + ", ".join(f"s{k} double" for k in range(6)))
    found = found.select(F.least("a", "b").alias("series_a"), F.greatest("a", "b").alias("series_b"), "*", (F.col("a") < F.col("b")).alias("first"))
    x, y = (F.when(F.col("first"), F.col(f"s{m}")).otherwise(F.col(f"s{n}")) for m, n in ((1, 2), (2, 1)))
    xx, yy = (F.when(F.col("first"), F.col(f"s{m}")).otherwise(F.col(f"s{n}")) for m, n in ((4, 5), (5, 4)))
    cells = found.select("series_a", "series_b", F.col("s0").alias("n"), x.alias("x"), y.alias("y"), F.col("s3").alias("xy"), xx.alias("xx"), yy.alias("yy"))
    total = cells if chunks == 1 else cells.groupBy("series_a", "series_b").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xy", "xx", "yy")])
    covariance = F.col("xy") - F.try_divide(F.col("x") * F.col("y"), "n")
    spread = [F.greatest(F.col(q) - F.try_divide(F.col(m) * F.col(m), "n"), F.lit(0.0)) for q, m in (("xx", "x"), ("yy", "y"))]
    varies = (spread[0] > 1e-12 * F.col("n")) & (spread[1] > 1e-12 * F.col("n"))
    return total.select("series_a", "series_b", F.when(varies, F.try_divide(covariance, F.sqrt(spread[0]) * F.sqrt(spread[1]))).alias("r"))


def spearman(aligned: DataFrame) -> DataFrame:
    return pearson(ranked(aligned))


def runs(series: DataFrame) -> DataFrame:
    """(series, at, n, total, value): what ``align`` makes, told by its runs instead of its cells.

    All ``total`` distinct times are numbered, range by range; a sample holds from its time's number
    (the first one from 0) for ``n`` times, up to the series' next sample.  So there are as many rows
    as samples, whatever the number of series.  A series without any value is one run of null.
    """
    require_columns(series, "series", TIME, "value")
    one = series.groupBy("series", TIME).agg(F.avg("value").alias("value"))
    times = sums_before(one.select(TIME).distinct(), [TIME], F.lit(1))
    placed = one.join(times, TIME).select("series", F.col("_before").cast("long").alias("at"), F.col("_total").cast("long").alias("total"), "value")
    found = placed.groupBy("series").agg(F.min("at").alias("_first"), F.count("value").alias("_known")).withColumnRenamed("series", "_series")
    kept = placed.join(found, F.col("series") == F.col("_series")).filter("value is not null or (_known = 0 and at = _first)")
    w = Window.partitionBy("series").orderBy("at")
    begun = kept.select("series", F.when(F.row_number().over(w) == 1, 0).otherwise(F.col("at")).cast("long").alias("at"), F.lead("at").over(w).alias("_next"), "total", "value")
    return begun.select("series", "at", (F.coalesce("_next", "total") - F.col("at")).alias("n"), "total", "value")


def ranked_runs(found: DataFrame) -> DataFrame:
    """``ranked`` for runs: average ranks of values within their series, each counted for its ``n`` times."""
    sizes = found.groupBy("series", "value").agg(F.sum("n").alias("c"))
    smaller = F.coalesce(F.sum("c").over(Window.partitionBy("series").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = sizes.select(F.col("series").alias("_series"), F.col("value").alias("_value"), (smaller + (F.col("c") + 1) / 2.0).alias("rank"))
    met = found.join(ranks, (F.col("series") == F.col("_series")) & F.col("value").eqNullSafe(F.col("_value")))
    return met.select("series", "at", "n", "total", F.col("rank").alias("value"))


def pearson_of_runs(found: DataFrame, width: int = WIDTH, times: int = TIMES) -> DataFrame:
    """``pearson`` of what ``align`` would make, without a row for every series and time.

    Times are cut into chunks of ``times``; a chunk holds the samples in it and, from each series, one
    value with which it begins.  A group spreads a chunk's runs over its times as a matrix of ``times`` by
    some ``width`` series, and sums products as ``pearson`` does.
    """
    blocks, chunks = _parts(found, "series", width), max(1, -(-(found.agg(F.max("total")).first()[0] or 0) // times))
    means = found.groupBy("series").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("_mean")).withColumnRenamed("series", "_series")
    off = found.join(means, F.col("series") == F.col("_series")).withColumn("v", F.col("value") - F.col("_mean"))
    first, last = F.ceil(F.col("at") / times).cast("long"), F.floor((F.col("at") + F.col("n") - 1) / times).cast("long")
    begins = F.when(first <= last, F.transform(F.sequence(first, last), lambda c: c * times)).otherwise(F.array().cast("array<bigint>"))
    own = F.when(F.col("at") % times > 0, F.array("at")).otherwise(F.array().cast("array<bigint>"))
    block = F.pmod(F.xxhash64("series"), F.lit(blocks)).cast("int").alias("block")
    cells = off.select("series", block, "total", "v", F.explode(F.concat(own, begins)).alias("at")).withColumn("chunk", F.floor(F.col("at") / times).cast("long"))
    # one shuffle: both groupings find their rows together
    dealt = cells.repartition("chunk", "block").groupBy("chunk", "block", "total", "series").agg(F.array_sort(F.collect_list(F.struct((F.col("at") - F.col("chunk") * times).cast("int").alias("at"), "v"))).alias("c"))
    rows = dealt.groupBy("chunk", "block", "total").agg(F.array_sort(F.collect_list(F.struct("series", "c"))).alias("s"))
    long = F.least(F.lit(times).cast("long"), F.col("total") - F.col("chunk") * times).cast("int")
    rows = rows.select("chunk", "block", F.col("s.series").alias("names"), long.alias("long"), F.transform("s.c", F.size).alias("counts"), F.flatten("s.c").getField("at").alias("starts"), F.flatten("s.c").getField("v").alias("values"))

    def spread(g: pa.Table, k: int, series: int) -> np.ndarray:
        n, at = g["long"][k].as_py(), g["starts"][k].values.to_numpy()
        ends = np.append(at[1:], n)
        ends[np.cumsum(g["counts"][k].values.to_numpy()) - 1] = n
        return np.repeat(g["values"][k].values.to_numpy(zero_copy_only=False).astype(float), ends - at).reshape(series, n).T

    return _products(rows, blocks, chunks, spread)


def correlation_of_samples(series: DataFrame, method: str = "pearson", width: int = WIDTH) -> DataFrame:
    """``correlation`` of aligned series, from their samples as they are.

    Pearson and Spearman go by runs; Kendall, which compares all times of a pair, aligns first.
    """
    if method not in ("pearson", "spearman"):
        return correlation(align(series), method)
    found = runs(series)
    return pearson_of_runs(found if method == "pearson" else ranked_runs(found), width)


def _inversions(y: np.ndarray) -> int:
    """Pairs i < j with y[i] > y[j], by merging sorted halves."""
    total, width, y = 0, 1, y.copy()
    while width < len(y):
        for lo in range(0, len(y) - width, 2 * width):
            left, right = y[lo : lo + width], y[lo + width : lo + 2 * width]
            total += int((len(left) - np.searchsorted(left, right, side="right")).sum())
            y[lo : lo + 2 * width] = np.sort(y[lo : lo + 2 * width], kind="stable")
        width *= 2
    return total


def _tied(*columns: np.ndarray) -> int:
    counts = np.unique(np.stack(columns), axis=1, return_counts=True)[1]
    return int((counts * (counts - 1) // 2).sum())


def tau_b(x: np.ndarray, y: np.ndarray) -> float | None:
    """Kendall's tau-b in O(n log n); None where one side does not vary."""
    n0 = len(x) * (len(x) - 1) // 2
    tx, ty, both = _tied(x), _tied(y), _tied(x, y)
    if n0 in (tx, ty):
        return None
    order = np.lexsort((y, x))
    discordant = _inversions(y[order])
    return float((n0 - tx - ty + both - 2 * discordant) / np.sqrt(float(n0 - tx) * float(n0 - ty)))


#: Times of a pair that a task puts in order at once, and the most ranges that its values are dealt into.
PAIR_ROWS, PAIR_RANGES = 50_000, 500


def _agreement(x: np.ndarray, y: np.ndarray) -> int:
    """Pairs of rows in the same order under x and y, less those in opposite order."""
    n0 = len(x) * (len(x) - 1) // 2
    return n0 - _tied(x) - _tied(y) + _tied(x, y) - 2 * _inversions(y[np.lexsort((y, x))])


def _part(v: str, cuts: str, n: int) -> Column:
    """Range of a value: 2 i between cuts i - 1 and i, 2 i + 1 at cut i itself (the first of equal ones)."""
    cut = [F.col(cuts)[k] for k in range(n)]
    below = reduce(Column.__add__, [(c < F.col(v)).cast("int") for c in cut])
    return 2 * below + reduce(Column.__or__, [c == F.col(v) for c in cut]).cast("int")


def _across(pdf: pd.DataFrame) -> int:
    """Agreement of rows that differ in both ranges, from the counts of a two-dimensional histogram."""
    h = np.zeros((int(pdf["pa"].max()) + 1, int(pdf["pb"].max()) + 1))
    h[pdf["pa"], pdf["pb"]] = pdf["n"]
    total = 0
    later = np.zeros(h.shape[1])  # rows of all later ranges of x, by range of y
    for row in h[::-1]:
        above = np.concatenate([np.cumsum(later[::-1])[::-1][1:], [0.0]])
        below = np.concatenate([[0.0], np.cumsum(later)[:-1]])
        total += sum(int(c) * int(d) for c, d in zip(row, above - below, strict=True) if c)
        later += row
    return total


def kendall(aligned: DataFrame, most_rows: int = PAIR_ROWS, most_ranges: int = PAIR_RANGES) -> DataFrame:
    """tau-b of every pair of series; null where one side does not vary.

    Up to ``most_rows`` times, a pair is one group.  Beyond, each series' values are dealt into ranges
    between some of its quantiles, which are ranges of their own, so that many equal values need no
    order.  Rows of a pair that differ in both ranges are compared by a histogram of two dimensions, rows
    of one range of x in that range's task, rows of one range of y but different ones of x in the task
    of that range; no task holds all times of a pair.
    """
    met = pairs(aligned).filter("x is not null and y is not null")
    longest = aligned.groupBy("series").agg(F.count("value").alias("n")).agg(F.max("n").alias("n")).first().n or 0
    schema = "series_a string, series_b string, r double"

    def result(pdf: pd.DataFrame, r: float | None) -> pd.DataFrame:
        return pd.DataFrame({"series_a": [pdf["series_a"].iat[0]], "series_b": [pdf["series_b"].iat[0]], "r": pd.array([r], dtype="Float64")})

    if longest <= most_rows:
        return met.groupBy("series_a", "series_b").applyInPandas(lambda pdf: result(pdf, tau_b(pdf["x"].to_numpy(float), pdf["y"].to_numpy(float))), schema)
    n_cuts = max(1, min(most_ranges, -(-longest // most_rows)) - 1)
    shares = F.array(*[F.lit((k + 1) / (n_cuts + 1)) for k in range(n_cuts)])
    cuts = aligned.groupBy("series").agg(F.percentile_approx("value", shares, F.lit(100 * n_cuts)).alias("cuts"))
    dealt = aligned.filter("value is not null").join(cuts, "series").select("series", TIME, "value", _part("value", "cuts", n_cuts).alias("part"))
    left = dealt.select(F.col("series").alias("series_a"), TIME, F.col("value").alias("x"), F.col("part").alias("pa"))
    right = dealt.select(F.col("series").alias("series_b"), TIME, F.col("value").alias("y"), F.col("part").alias("pb"))
    rows = left.join(right, TIME).filter("series_a < series_b")
    key = ["series_a", "series_b"]

    def in_range(own: str, other: str) -> DataFrame:
        """Agreement and ties inside each range of ``own``; of the second side only rows that differ in the first."""

        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            x, y = pdf["x"].to_numpy(float), pdf["y"].to_numpy(float)
            found = _agreement(x, y)
            if own == "pb":
                found -= sum(_agreement(g["x"].to_numpy(float), g["y"].to_numpy(float)) for _, g in pdf.groupby(other))
            return pd.DataFrame({"series_a": [pdf["series_a"].iat[0]], "series_b": [pdf["series_b"].iat[0]], "s": [found], "tied": [_tied(x if own == "pa" else y)]})

        return rows.filter(F.col(own) % 2 == 0).groupBy(*key, own).applyInPandas(one, "series_a string, series_b string, s long, tied long")

    # values that stand for themselves are tied with each other and need no order
    alone = lambda own: rows.filter(F.col(own) % 2 == 1).groupBy(*key, own).agg(F.count(F.lit(1)).alias("c")).select(*key, F.lit(0).cast("long").alias("s"), F.expr("c * (c - 1) div 2").alias("tied"))
    sides = [in_range(own, other).unionByName(alone(own)).select(*key, "s", *[(F.col("tied") if c == own else F.lit(0).cast("long")).alias(t) for c, t in (("pa", "tx"), ("pb", "ty"))], F.lit(0).cast("long").alias("n")) for own, other in (("pa", "pb"), ("pb", "pa"))]
    counts = rows.groupBy(*key, "pa", "pb").agg(F.count(F.lit(1)).alias("n"))

    def between(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"series_a": [pdf["series_a"].iat[0]], "series_b": [pdf["series_b"].iat[0]], "s": [_across(pdf)], "tx": [0], "ty": [0], "n": [int(pdf["n"].sum())]})

    grid = counts.groupBy(*key).applyInPandas(between, "series_a string, series_b string, s long, tx long, ty long, n long")
    total = reduce(DataFrame.unionByName, [*sides, grid]).groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("s", "tx", "ty", "n")])
    n0 = F.expr("n * (n - 1) div 2")
    return total.select(*key, F.when((n0 > F.col("tx")) & (n0 > F.col("ty")), F.col("s") / F.sqrt((n0 - F.col("tx")).cast("double") * (n0 - F.col("ty")).cast("double"))).alias("r"))


METHODS = {"pearson": pearson, "spearman": spearman, "kendall": kendall}


def correlation(aligned: DataFrame, method: str = "pearson") -> DataFrame:
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}")
    return METHODS[method](aligned)


def high_correlations(matrix: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Pairs beyond the threshold, strongest first; undefined ones never pass."""
    return matrix.filter((F.col("series_a") < F.col("series_b")) & (F.abs("r") > threshold)).orderBy(F.desc(F.abs("r")), "series_a", "series_b")


def correlation_summary(matrix: DataFrame) -> DataFrame:
    """Mean, median, greatest and least of the defined coefficients between different series."""
    r = matrix.filter("series_a <> series_b and r is not null")
    return r.agg(F.avg("r").alias("mean"), F.percentile("r", F.lit(0.5)).alias("median"), F.max("r").alias("max"), F.min("r").alias("min"))


def write_square(matrix: DataFrame, path: str, names: list[str] | None = None) -> None:
    """The square form as CSV with a header; undefined coefficients are empty."""
    write_frame(square(matrix, names), path)


def unpivoted(wide: DataFrame) -> DataFrame:
    """(series_a, series_b, r) of the square form, each pair both ways and with itself."""
    names = [c for c in wide.columns if c != "series"]
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("series_b"), F.col(f"`{c}`").cast("double").alias("r")) for c in names]))
    return wide.select(F.col("series").alias("series_a"), rows.alias("c")).select("series_a", "c.series_b", "c.r")


def square(matrix: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The square form, one column a series, for few series."""
    turned = matrix.select(F.col("series_b").alias("series_a"), F.col("series_a").alias("series_b"), "r")
    both = matrix.select("series_a", "series_b", "r").unionByName(turned)
    own = both.select("series_a").distinct().select("series_a", F.col("series_a").alias("series_b"), F.lit(1.0).alias("r"))
    return both.unionByName(own).groupBy(F.col("series_a").alias("series")).pivot("series_b", names).agg(F.first("r")).orderBy("series")
