"""Exact deduplication by a tree-merge of sorted digest runs (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import require

RUNS = 64
FAN_IN = 8
RANGES = 1024
#: The order of a run.
KEY = ("range", "run", "digest", "proof", "size")


def _best(keep: str, id_: str) -> Column:
    """An aggregate of structs, so that Spark merges sorted rows; null ids come last."""
    if keep == "largest":
        return F.max(F.struct(F.col(id_).isNotNull().alias("known"), F.col(id_).alias("id"))).alias("best")
    return F.min(F.struct(F.col(id_).isNull().alias("unknown"), F.col(id_).alias("id"))).alias("best")


def _merged(entries: DataFrame, keep: str) -> DataFrame:
    """Runs in digest order with one entry a text: sorted rows merge as they stream by."""
    return entries.groupBy(*KEY).agg(_best(keep, "id"), F.sum("n").alias("n")).select(*KEY, F.col("best.id").alias("id"), "n")


def digest_runs(docs: DataFrame, id_col: str, text_col: str, keep: str, runs: int = RUNS, ranges: int = RANGES) -> DataFrame:
    """Level 0: the sorted runs of the partitions, copies within a run counted before they are shuffled."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.xxhash64(text)
    entry = docs.select(
        F.pmod(digest, F.lit(ranges)).cast("int").alias("range"),
        F.pmod(F.spark_partition_id(), F.lit(runs)).alias("run"),
        digest.alias("digest"),
        F.unhex(F.sha2(text, 256)).alias("proof"),
        F.octet_length(text).alias("size"),
        F.col(id_col).alias("id"),
        F.lit(1).cast("long").alias("n"),
    )
    return _merged(entry, keep)


def merge_runs(runs: DataFrame, keep: str, n_runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """Merge the sorted runs in rounds until one run is left for each digest range.

    In a round, ``fan_in`` neighbouring runs are exchanged and merged in digest
    order by a streaming, sort-based aggregate: no hash table, and what does
    not fit in memory spills as sorted runs.  The digest space is cut into
    ranges, whose pieces meet in different tasks, so no task ever holds a
    whole run.  A level keeps one entry per digest and proof (SHA-256 and byte
    length tell apart texts that share the short digest) with the best id so
    far, so a group of copies of any size is ``fan_in`` entries at most.
    """
    level, left = runs, n_runs
    while left > 1:
        left = -(-left // fan_in)
        met = level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        level = _merged(met.repartition("range", "run"), keep)
    return level.drop("range", "run")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", n_runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are compared as they are; null counts as empty.  ``keep`` says
    whether the smallest or the largest id of equal texts stays.  Null ids
    never stay beside another id; a group of null ids only has ``keep_id``
    null and stays.  Rows equal in id and text get the same verdict.
    """
    require(docs, id_col, text_col)
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    if fan_in < 2 or n_runs < 1:
        raise ValueError("fan_in must be at least 2 and n_runs at least 1")
    groups = merge_runs(digest_runs(docs, id_col, text_col, keep, n_runs), keep, n_runs, fan_in)
    copies = groups.filter("n > 1").select("proof", F.col("id").alias("_keep"), F.col("n").alias("_n"))
    rows = docs.select(F.col(id_col), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("proof"))
    # A proof that many rows share is a skewed key of a plain sort-merge join,
    # which adaptive execution splits; the other side has one row per group.
    joined = rows.join(copies.hint("merge"), "proof", "left")
    alone = F.col("_n").isNull()
    keep_id = F.when(alone, F.col(id_col)).otherwise(F.col("_keep"))
    return joined.select(
        F.col(id_col),
        keep_id.alias("keep_id"),
        F.coalesce(F.col("_n"), F.lit(1)).cast("long").alias("group_size"),
        F.col(id_col).eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("proof")).alias("text_sha256"),
    )
