"""Sums of lag products of long series, block by block."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..keys import SERIES, TIME, require_columns
from .windows import numbered_by_days

#: Rows of a block: what a task holds of a series.
BLOCK = 65_536


def products_of(values: np.ndarray, lags: tuple[int, ...], first: int) -> np.ndarray:
    """Sums of v[t - i] v[t - j] over t >= ``first``, for all i and j of ``lags``."""
    n = len(values)
    if first >= n:
        return np.zeros((len(lags), len(lags)))
    z = np.column_stack([values[first - k : n - k] for k in lags])
    return z.T @ z


def differences(values: np.ndarray, power: np.ndarray) -> np.ndarray:
    """The filter ``power`` (by lags) at every place that has all its lags."""
    return np.convolve(values, power, mode="valid") if len(values) >= len(power) else np.zeros(0)


def lag_products(df: DataFrame, lags: tuple[int, ...], keep: int, powers: tuple[tuple[float, ...], ...] = ((1.0,),), block: int = BLOCK) -> DataFrame:
    """(series, n, center, head, tail, products): one row a series, whatever its length.

    ``products`` are, for each of the difference filters ``powers``, the sums of w[t - i] w[t - j] over
    all t that have every lag of every filter, row by row of the matrix of ``lags``; w is the filtered
    v - center.  ``center`` is the series' mean, ``head`` and ``tail`` its first and last ``keep`` values.
    Rows are numbered day by day and cut into blocks, each with the rows that it reaches back to, so a
    task holds ``block`` rows and the longest reach; the sums of the blocks are added by Spark.  Null,
    NaN and infinite values are left out.
    """
    reach = max(lags) + max(len(p) for p in powers) - 1
    size = max(block, reach + 1)

    def sums(at: np.ndarray, v: np.ndarray, n: int, center: float, start: int) -> np.ndarray:
        first = max(reach, start) - int(at[0])
        return np.concatenate([products_of(differences(v - center, np.array(p)), lags, first - len(p) + 1).ravel() for p in powers])

    return block_sums(df, sums, "products", keep, size, reach)


def block_sums(df: DataFrame, sums, name: str, keep: int, block: int = BLOCK, reach: int = 0) -> DataFrame:
    """(series, n, center, head, tail, ``name``): sums that a function makes of a series' blocks, added up.

    ``sums(row numbers, values, n, center, first own row number)`` gives a vector; it sees a block's rows
    and the ``reach`` rows before them.
    """
    require_columns(df, *SERIES, TIME, "value")
    value = F.col("value").cast("double")
    found = df.withColumn("value", value).filter(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf")))
    rows = numbered_by_days(found, "value").select(*SERIES, "row_no", "n_rows", "value", "center")
    own = F.floor(F.col("row_no") / block).cast("long")
    late = (F.col("row_no") % block >= block - reach) & (own < F.floor((F.col("n_rows") - 1) / block))
    dealt = rows.withColumn("_block", F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own))))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_no")
        at, v, center = pdf["row_no"].to_numpy(), pdf["value"].to_numpy(float), float(pdf["center"].iat[0])
        n, start = int(pdf["n_rows"].iat[0]), int(pdf["_block"].iat[0]) * block
        mine = at >= start
        ends = {"head": v[mine & (at < keep)], "tail": v[mine & (at >= n - keep)]}
        made = sums(at, v, n, center, start)
        return pd.DataFrame({**{k: [pdf[k].iat[0]] for k in SERIES}, "block": [start // block], "n": [n], "center": [center], **{k: [e.tolist()] for k, e in ends.items()}, "sums": [made.tolist()]})

    schema = "metric_name string, container_name string, block long, n long, center double, head array<double>, tail array<double>, sums array<double>"
    parts = dealt.groupBy(*SERIES, "_block").applyInPandas(one, schema)
    # of the blocks between head and tail only their sums go on
    cells = parts.select(*SERIES, "n", "center", "block", "head", "tail", F.posexplode("sums").alias("cell", "s"))
    ends = F.when((F.col("cell") == 0) & (F.size("head") + F.size("tail") > 0), F.struct("block", "head", "tail"))
    summed = cells.groupBy(*SERIES, "n", "center", "cell").agg(F.sum("s").alias("s"), F.collect_list(ends).alias("ends"))
    whole = summed.groupBy(*SERIES, "n", "center").agg(F.array_sort(F.collect_list(F.struct("cell", "s"))).alias("g"), F.array_sort(F.flatten(F.collect_list("ends"))).alias("e"))
    return whole.select(*SERIES, "n", "center", F.flatten("e.head").alias("head"), F.flatten("e.tail").alias("tail"), F.col("g.s").alias(name))
