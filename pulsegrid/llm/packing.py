"""Packing into batches of near-equal lengths with optimal bucket boundaries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import require

WORD = r"[^\x20\x09-\x0D]+"


def optimal_boundaries(lengths: list[int], counts: list[int], n_buckets: int) -> list[int]:
    """Upper bounds of at most ``n_buckets`` buckets with the least padding.

    ``lengths`` ascend; a sequence is padded to the bound of its bucket.  The
    dynamic programme takes, for every prefix of the histogram, the best last
    bucket; ties go to the longest last bucket.
    """
    if not lengths:
        return []
    size, n = np.asarray(lengths, dtype=np.int64), np.asarray(counts, dtype=np.int64)
    below = np.concatenate([[0], np.cumsum(n)])
    filled = np.concatenate([[0], np.cumsum(n * size)])
    m = len(size)
    # padding[j, i]: one bucket over entries i..j-1
    padding = np.full((m + 1, m + 1), np.iinfo(np.int64).max // 4)
    for j in range(1, m + 1):
        padding[j, :j] = size[j - 1] * (below[j] - below[:j]) - (filled[j] - filled[:j])
    best = padding[:, 0].copy()
    best[0] = 0
    cuts = []
    for _ in range(1, min(n_buckets, m)):
        total = best[None, :] + padding
        cut = total.argmin(axis=1)
        better = total[np.arange(m + 1), cut]
        better[0] = 0
        cut = np.where(better < best, cut, -1)
        cuts.append(cut)
        best = np.minimum(best, better)
    bounds, j = [], m
    for cut in reversed(cuts):
        if j > 0 and cut[j] >= 0:
            bounds.append(int(size[j - 1]))
            j = int(cut[j])
    if j > 0:
        bounds.append(int(size[j - 1]))
    return sorted(bounds)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_len: int = 2048) -> DataFrame:
    """Cut every document into pieces of at most ``max_len`` words, none dropped.

    A document without words (null, empty, blank) has no piece.  Only the id
    and the pieces' places and lengths are returned; documents that share an
    id, or repeat, have pieces of their own.
    """
    n = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    counted = docs.select(F.col(id_col).alias("doc_id"), n.alias("n")).filter("n > 0")
    starts = counted.select("doc_id", "n", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(max_len).cast("long"))).alias("piece", "start"))
    return starts.select("doc_id", "piece", "start", F.least(F.col("n") - F.col("start"), F.lit(max_len)).cast("int").alias("n_tokens"))


#: Rows of a bucket that one task numbers, on average.
SLICE_ROWS = 100_000


def pack(parts: DataFrame, n_buckets: int = 16, budget: int = 16_384, max_len: int = 2048, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Batches of pieces: ``parts`` plus ``bucket`` (padded length) and ``batch``.

    The histogram of the lengths 1..``max_len`` is counted over all rows; its
    ``max_len`` entries bound what the driver gets.  A bucket of bound b takes
    ``budget // b`` pieces a batch.  Each bucket is cut into slices by hash, as
    many as its count asks for, and places come from the counts of the slices,
    so no bucket is numbered by one task; every batch of a bucket but its last
    is full.  Order in a bucket: slice, doc_id, piece; equal ones in any order.
    Rows of length null or under 1 are not packed; longer ones raise.  Columns
    ``bucket`` and ``batch`` of the input are replaced, all others kept.
    """
    require(parts, "doc_id", "piece", "n_tokens")
    if budget < max_len:
        raise ValueError("the budget must hold one piece of max_len")
    spark = parts.sparkSession
    parts = parts.drop("bucket", "batch").filter("n_tokens >= 1")
    longest = F.assert_true(F.col("n_tokens") <= max_len, F.lit("a piece is longer than max_len"))
    histogram = parts.filter(longest.isNull()).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).orderBy("n_tokens").collect()
    bounds = optimal_boundaries([r.n_tokens for r in histogram], [r.n for r in histogram], n_buckets) or [max_len]
    bucket_of = [next(b for b in bounds if b >= min(k, bounds[-1])) for k in range(bounds[-1] + 1)]
    rows_of = {b: sum(r.n for r in histogram if bucket_of[r.n_tokens] == b) for b in bounds}
    slices_of = [max(4, -(-rows_of[b] // slice_rows)) for b in bucket_of]
    length = F.col("_packed.n_tokens") + 1
    named = parts.select(F.struct(*[F.col(f"`{c}`") for c in parts.columns]).alias("_packed"))
    bucket = F.element_at(F.array(*[F.lit(b) for b in bucket_of]), length)
    n_slices = F.element_at(F.array(*[F.lit(k) for k in slices_of]), length)
    placed = named.withColumn("_bucket", bucket).withColumn("_slice", F.pmod(F.xxhash64("_packed.doc_id", "_packed.piece"), n_slices))
    counts = placed.groupBy("_bucket", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_bucket").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_bucket", "_slice", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_bucket", "_slice").orderBy("_packed.doc_id", "_packed.piece")) - 1
    ranked = placed.withColumn("_place", place).join(offsets, ["_bucket", "_slice"])
    number = F.floor((F.col("_before") + F.col("_place")) / F.floor(F.lit(budget) / F.col("_bucket"))).cast("long")
    return ranked.select("_packed.*", F.col("_bucket").alias("bucket"), F.concat_ws("-", "_bucket", number).alias("batch"))


def batches(packed: DataFrame) -> DataFrame:
    """Per batch: pieces, tokens, padding and the padded size."""
    return packed.groupBy("bucket", "batch").agg(
        F.count(F.lit(1)).alias("n_pieces"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("bucket") - F.col("n_tokens")).alias("n_padding"),
    )
