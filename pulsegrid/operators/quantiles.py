"""Exact quantiles of groups of any size, by narrowing ranges of values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..keys import require_columns
from ..storage import checkpointed

#: Rows of a range that are put in order in one task; wider ranges are narrowed first.
MOST = 100_000
#: Values that cut a range in every round.
CUTS = 31


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)], F.lit(True))


def _met(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the other's columns for their group; null is a group, too."""
    named = other.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *[c for c in other.columns if c not in keys])
    return rows.join(named, _same(keys, [f"_of_{k}" for k in keys])).drop(*[f"_of_{k}" for k in keys])


def met_by(plain: DataFrame, found: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Every group of ``plain`` with its ``q``, null where it has no values."""
    other = found.select(*[F.col(b).alias(f"_of_{i}") for i, b in enumerate(by)], "q")
    return plain.join(other, _same(list(by), [f"_of_{i}" for i in range(len(by))]), "left").select(*plain.columns, "q")


def _ranks(n: Column, share: float) -> tuple[Column, Column, Column]:
    """Where a share of ``n`` ordered values lies: its place, and the whole places around."""
    at = (n - 1) * F.lit(float(share))
    return at, F.floor(at).cast("long"), F.ceil(at).cast("long")


def _inside(v: Column) -> Column:
    """The range that holds the value: open, or of one value."""
    return F.get(F.filter("_ranges", lambda r: F.when(r["one"], v == r["hi"]).otherwise((r["lo"].isNull() | (v > r["lo"])) & (r["hi"].isNull() | (v < r["hi"])))), F.lit(0))


def _narrowed(rows: DataFrame, state: DataFrame, keys: list[str], cuts: int) -> DataFrame:
    """The state with each range cut by some of its values; parts without a wanted rank go.

    The parts are the values themselves and what lies between two of them, so a value that a third of
    the rows have ends as a range of its own.
    """
    held = _met(rows, state.select(*keys, "_ranges"), keys).withColumn("_r", _inside(F.col("_v"))).filter("_r is not null").drop("_ranges")
    shares = F.array(*[F.lit((k + 1) / (cuts + 1)) for k in range(cuts)])
    found = held.groupBy(*keys, F.col("_r.id").alias("_id")).agg(F.percentile_approx("_v", shares, F.lit(100 * cuts)).alias("_cuts"))
    met = _met(held.withColumn("_id", F.col("_r.id")), found, [*keys, "_id"])
    v, cut = F.col("_v"), [F.col("_cuts")[k] for k in range(cuts)]
    below = reduce(Column.__add__, [(c < v).cast("int") for c in cut])
    on = reduce(Column.__or__, [c == v for c in cut])
    parts = met.withColumn("_part", 2 * below + on.cast("int"))
    # open part i lies after cut i - 1 and before cut i; equal cuts leave parts between them empty
    first = F.get("_cuts", (F.col("_part") / 2).cast("int"))
    before = F.get("_cuts", (F.col("_part") / 2).cast("int") - 1)
    counted = parts.groupBy(*keys, "_id", "_part", "_r", "_cuts").agg(F.sum("_w").alias("weight"), F.count(F.lit(1)).alias("rows"))
    one = (F.col("_part") % 2) == 1
    bounds = {"lo": F.when(~one, F.coalesce(before, F.col("_r.lo"))), "hi": F.when(one, first).otherwise(F.coalesce(first, F.col("_r.hi")))}
    order = Window.partitionBy(*keys, "_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranged = counted.withColumns({**bounds, "one": one, "below": F.col("_r.below") + F.coalesce(F.sum("weight").over(order), F.lit(0))})
    kept = _met(ranged, state.select(*keys, "_wanted", "_n"), keys).filter(F.exists("_wanted", lambda k: (k >= F.col("below")) & (k < F.col("below") + F.col("weight"))))
    again = F.array_sort(F.collect_list(F.struct("below", "lo", "hi", "one", "rows")))
    listed = kept.groupBy(*keys, "_n", "_wanted").agg(again.alias("_list"))
    numbered = F.transform("_list", lambda r, i: F.struct(i.cast("int").alias("id"), r["below"].alias("below"), r["lo"].alias("lo"), r["hi"].alias("hi"), r["one"].alias("one"), r["rows"].alias("rows")))
    return listed.select(*keys, "_n", "_wanted", numbered.alias("_ranges"))


def quantiles(df: DataFrame, column: str, shares: tuple[float, ...], by: tuple[str, ...] = (), weight: str | None = None, most: int = MOST, cuts: int = CUTS) -> DataFrame:
    """(by..., q): the exact quantiles of a column, linearly interpolated, in one array a group.

    They equal ``percentile``, whose aggregate keeps every distinct value of a group.  Here a group of
    more than ``most`` rows is narrowed first: some of its values cut it into parts, whose rows are
    counted exactly, and only parts that hold a wanted rank stay, until none of several values has more
    rows than ``most``.  A round is two passes with pre-aggregation; a job a round tells whether it was
    the last.  ``weight``: an integer column that tells how often a row counts.  Nulls are left out, and
    groups without any other value.
    """
    require_columns(df, column, *by, *([weight] if weight else []))
    keys = [f"_k{i}" for i in range(len(by))] or ["_k0"]
    named = [F.col(b).alias(k) for b, k in zip(by, keys, strict=False)] or [F.lit(0).alias("_k0")]
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    rows = df.select(*named, F.col(column).cast("double").alias("_v"), w.alias("_w")).filter("_v is not null and _w > 0")
    totals = rows.groupBy(*keys).agg(F.sum("_w").alias("_n"), F.count(F.lit(1)).alias("rows"))
    wanted = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.array(*_ranks(F.col("_n"), s)[1:]) for s in shares]))))
    whole = F.struct(F.lit(0).alias("id"), F.lit(0).cast("long").alias("below"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"), F.lit(False).alias("one"), F.col("rows").alias("rows"))
    state = checkpointed(totals.select(*keys, "_n", wanted.alias("_wanted"), F.array(whole).alias("_ranges")))
    while not state.filter(F.exists("_ranges", lambda r: ~r["one"] & (r["rows"] > most))).isEmpty():
        state = checkpointed(_narrowed(rows, state, keys, cuts))
    held = _met(rows, state, keys).withColumn("_r", _inside(F.col("_v"))).filter("_r is not null")
    values = held.groupBy(*keys, "_n", "_wanted", F.col("_r.id").alias("_id"), F.col("_r.below").alias("_below"), "_v").agg(F.sum("_w").alias("_w"))
    order = Window.partitionBy(*keys, "_id").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_below") + F.coalesce(F.sum("_w").over(order), F.lit(0))
    hit = values.withColumn("_from", start).withColumn("_k", F.explode(F.filter("_wanted", lambda k: (k >= F.col("_from")) & (k < F.col("_from") + F.col("_w")))))
    got = hit.groupBy(*keys, "_n").agg(F.map_from_entries(F.collect_list(F.struct("_k", "_v"))).alias("_at"))

    def value(share: float) -> Column:
        at, low, high = _ranks(F.col("_n"), share)
        a, b = F.try_element_at("_at", low), F.try_element_at("_at", high)
        return F.when((low == high) | (a == b), a).otherwise((high - at) * a + (at - low) * b)

    return got.select(*[F.col(k).alias(b) for k, b in zip(keys, by, strict=False)], F.array(*[value(s) for s in shares]).alias("q"))
