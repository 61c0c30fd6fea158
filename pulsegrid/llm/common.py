"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and leave every other letter alone."""
    return F.translate(c, UPPER, LOWER)


def _shared_root(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    A temporary folder of this machine is taken where all runs on it (tests, a
    laptop); a cluster without either raises.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-ckpt-"))
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder."""
    _shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def row_tag(text: Column) -> Column:
    """128 bits of the text, which tell rows of one id apart; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of an Arrow batch: with texts of some KB, a few MB in a Python worker at once.
BATCH_ROWS = 2_000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """At most ``BATCH_ROWS`` rows in an Arrow batch of what runs inside; the session's setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = spark.conf.get(key)
    if not 0 < int(held) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, held)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet beside the checkpoints, and read it back.

    Like ``checkpointed``, but compressed and with column pruning on reading;
    the folder goes when the application's file system is closed.
    """
    spark = df.sparkSession
    path = shared_path(spark)
    schema = df.schema
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def shared_path(spark: SparkSession) -> str:
    """A new path beside the checkpoints, for a folder that goes like those of ``stored``."""
    sc = spark.sparkContext
    path = f"{_shared_root(spark)}/stored-{uuid.uuid4().hex}"
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(where)
    _STORED.add(path)
    return path


_STORED: set[str] = set()


def stored_paths() -> set[str]:
    """Folders that ``stored`` has written and nobody has dropped."""
    return set(_STORED)


def drop_stored(spark: SparkSession, paths: set[str]) -> None:
    """Delete folders of ``stored`` that no DataFrame still in use reads."""
    sc = spark.sparkContext
    for path in paths & _STORED:
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
        _STORED.discard(path)


#: 32 MB, whatever the number of keys.
MAX_FILTER_BITS = 1 << 28


def bit_filter(keys: DataFrame, key: str):
    """A broadcast bit array that holds every key of a long column.

    16 bits a key, ``MAX_FILTER_BITS`` (32 MB) at most: a fuller filter lets more other
    keys through but never stops one that is in it, so callers use it only to
    leave out work.
    """
    bits = int(min(max(16 * keys.count(), 1 << 14), MAX_FILTER_BITS)) // 64 * 64
    at = F.explode(F.array(*_bit_places(F.col(key), bits)))
    words = keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("mask"))
    out = np.zeros(bits // 64, dtype=np.int64)
    for batch in words.toArrow().to_batches():
        out[batch["word"].to_numpy()] = batch["mask"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(out)


_SHIFTS = (0, 11, 21, 31)


def _bit_places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.shiftrightunsigned(key, k), F.lit(bits - k)) for k in _SHIFTS]


def in_filter(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether ``bit_filter`` may hold each of the keys."""
    bits = len(words) * 64
    out = np.ones(len(keys), dtype=bool)
    for k in _SHIFTS:
        at = (keys.view(np.uint64) >> np.uint64(k)).astype(np.int64) % (bits - k) if k else keys % bits
        out &= (words[at >> 6] >> (at & 63)) & 1 == 1
    return out
