"""Dense container ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import container_name
from .order import sums_before


def discover_containers(df: DataFrame) -> DataFrame:
    """Distinct container names, from the column of that name or else from the labels."""
    if "container_name" in df.columns:
        names = df.select("container_name")
    elif "container_labels" in df.columns:
        names = df.select(container_name(F.col("container_labels")).alias("container_name"))
    else:
        raise ValueError("DataFrame needs container_name or container_labels")
    return names.dropna().distinct()


def build_vocabulary(df: DataFrame) -> DataFrame:
    """(container_name, container_id): ids 0, 1, ... by name, counted range by range of the names."""
    names = sums_before(discover_containers(df), ["container_name"], F.lit(1))
    return names.select("container_name", F.col("_before").cast("int").alias("container_id"))


def extend_vocabulary(vocabulary: DataFrame, df: DataFrame) -> DataFrame:
    """Known names keep their ids; new ones get the next ids, by name."""
    fresh = build_vocabulary(discover_containers(df).join(vocabulary, "container_name", "left_anti"))
    start = vocabulary.agg(F.coalesce(F.max("container_id") + 1, F.lit(0)).alias("_start"))
    numbered = fresh.crossJoin(F.broadcast(start)).select("container_name", (F.col("container_id") + F.col("_start")).cast("int").alias("container_id"))
    return vocabulary.select("container_name", F.col("container_id").cast("int")).unionByName(numbered)


def add_container_ids(df: DataFrame, vocabulary: DataFrame, strict: bool = True, column: str = "container_no") -> DataFrame:
    """Add the id of every row's container; unknown names raise, or get null if not ``strict``."""
    if "container_name" not in df.columns:
        raise ValueError("DataFrame must have a container_name column")
    names = vocabulary.select("container_name", F.col("container_id").alias(column))
    out = df.join(names, "container_name", "left")
    if strict:
        unknown = F.raise_error(F.concat(F.lit("unknown container: "), F.coalesce("container_name", F.lit("null")))).cast("int")
        out = out.withColumn(column, F.coalesce(column, unknown))
    return out.select(*[c for c in df.columns if c != column], column)


def container_names(ids: DataFrame, vocabulary: DataFrame, column: str = "container_no") -> DataFrame:
    """The reverse lookup: add ``container_name``."""
    return ids.join(vocabulary.select(F.col("container_id").alias(column), "container_name"), column, "left")


def restrict(df: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of the chosen containers (a semi-join on the common key columns)."""
    return df.join(chosen, [c for c in chosen.columns if c in df.columns], "left_semi")


def sample_containers(df: DataFrame, k: int, seed: int = 0, column: str = "container_name") -> DataFrame:
    """k distinct containers, or all if there are fewer, in the order of a seeded MD5."""
    return df.select(column).distinct().orderBy(_drawn(seed, column), column).limit(k)


def sample_rows(df: DataFrame, n: int, *keys: str, seed: int = 0) -> DataFrame:
    """n rows in the order of a seeded MD5 of their keys, without replacement."""
    return df.orderBy(_drawn(seed, *keys), *keys).limit(n)


def _drawn(seed: int, *keys: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))
