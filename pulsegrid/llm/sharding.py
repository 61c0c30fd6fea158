"""Placement of rows on shards through a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import require

TABLE_SIZE = 65_537


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """Slot -> index of the shard that owns it.

    Every shard prefers the slots in an order of its own, ``offset + j * skip``
    modulo the prime ``size``.  The shards take turns; each claims the first
    free slot of its order, so their shares differ by one slot at most, and a
    shard that leaves gives up its slots while few others move.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct and at least one")
    if not _is_prime(size) or size < len(shards):
        raise ValueError("the table size must be a prime of at least the number of shards")
    at = [_number(s, "offset") % size for s in shards]
    skip = [_number(s, "skip") % (size - 1) + 1 for s in shards] if size > 1 else [1] * len(shards)
    owner = [-1] * size
    for turn in range(size):
        k = turn % len(shards)
        while owner[at[k]] >= 0:
            at[k] = (at[k] + skip[k]) % size
        owner[at[k]] = k
    return owner


def assign_shards(df: DataFrame, key: str, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """Add ``slot`` and ``shard`` to every row by the key's hash.

    The table has ``size`` rows whatever the data's size, so broadcasting it is
    bounded by that parameter, and a row costs one hash and one lookup: no
    shuffle of ``df``.  A null key is placed like the empty string; equal keys
    share a shard; existing columns ``slot`` or ``shard`` are replaced.
    """
    require(df, key)
    spark = df.sparkSession
    rows = [(i, shards[k]) for i, k in enumerate(lookup_table(shards, size))]
    places = spark.createDataFrame(rows, "slot int, shard string")
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    slot = F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint"), F.lit(size)).cast("int")
    kept = df.drop("shard").withColumn("slot", slot)
    return kept.join(F.broadcast(places), "slot", "left").select(*[c for c in df.columns if c not in ("slot", "shard")], "slot", "shard")


def write_shards(df: DataFrame, key: str, shards: list[str], path: str, files_per_shard: int = 1, size: int = TABLE_SIZE) -> None:
    """Write the rows under ``path/shard=<name>/``, ``files_per_shard`` files each; columns ``slot`` and ``shard`` are not written as data."""
    placed = assign_shards(df, key, shards, size)
    part = F.pmod(F.col("slot"), F.lit(files_per_shard))
    placed.repartition(len(shards) * files_per_shard, "shard", part).drop("slot").write.partitionBy("shard").parquet(path)
