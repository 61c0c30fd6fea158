"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One half of the alternating star contraction, over edges (u, v)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.filter("v < u") if small else both
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    moved = near.filter("v > u") if not small else near
    kept = moved.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if small:
        kept = kept.union(least.select("u", F.col("m").alias("v")))
    return kept.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    """Two numbers that stay when no edge changes."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of an edge (a, b): the label is its component's least node.

    Alternates large stars (each node hands its larger neighbours to its least
    one) and small stars (each node hands its smaller neighbours and itself),
    which ends in a star for each component after a logarithmic number of
    rounds: no edge changes any more.  Nothing but the number and a sum of
    hashes of the edges reaches the driver.
    """
    now = checkpointed(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    was = _state(now)
    for _ in range(most_rounds):
        now = checkpointed(_star(_star(now, False), True))
        state = _state(now)
        if state == was:
            break
        was = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
