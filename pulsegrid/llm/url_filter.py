"""URL verdicts: longest rule first, then a Bloom filter cascade of listed keys."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, checkpointed, require

#: Fixed rules: verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
HASHES = 6
BITS_PER_KEY = 9
#: Bits of a cascade that are broadcast at once (32 MB).
MAX_BITS = 1 << 28


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as host + path, its verdict) of the longest rule that fits; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(rule_path))
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
    seed = np.uint64((level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    a, b = _mixed(h1 ^ seed), _mixed(h2 + seed) | np.uint64(1)
    return (a[:, None] + np.arange(HASHES, dtype=np.uint64)[None, :] * b[:, None]) % np.uint64(bits)


def _passes(words: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return ((words[(pos >> np.uint64(6)).astype(np.int64)] >> (pos & np.uint64(63))) & np.uint64(1)).all(axis=1)


def _hashes(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return pdf["h1"].to_numpy(np.int64).view(np.uint64), pdf["h2"].to_numpy(np.int64).view(np.uint64)


def key_hashes(key: Column) -> list[Column]:
    """128 bits stand for a key; two keys that share them are taken as one."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")]


def _level(keys: DataFrame, level: int, bits: int) -> np.ndarray:
    """The Bloom filter of ``keys``: bits set by tasks, words joined by OR."""

    def words(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            pos = np.unique(_positions(*_hashes(pdf), level, bits))
            word, at = np.unique((pos >> np.uint64(6)).astype(np.int64), return_index=True)
            if len(word):
                mask = np.bitwise_or.reduceat(np.uint64(1) << (pos & np.uint64(63)), at)
                yield pd.DataFrame({"word": word, "mask": mask.view(np.int64)})

    rows = keys.mapInPandas(words, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    out = np.zeros(-(-bits // 64), dtype=np.uint64)
    for batch in rows.toArrow().to_batches():
        out[batch["word"].to_numpy()] = batch["mask"].to_numpy().view(np.uint64)
    return out


def _passing(keys: DataFrame, words: np.ndarray, level: int, bits: int) -> DataFrame:
    held = keys.sparkSession.sparkContext.broadcast(words)

    def passing(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pdf[_passes(held.value, _positions(*_hashes(pdf), level, bits))]

    return checkpointed(keys.mapInPandas(passing, keys.schema))


def build_cascade(universe: DataFrame, listed: DataFrame) -> list[tuple[np.ndarray, int]]:
    """Levels of the cascade over distinct (h1, h2) of ``universe``.

    Odd levels encode listed keys, even ones the false positives among the
    others; each level holds only what the level before got wrong, until a
    level gets nothing wrong.  No key is left to a join.
    """
    inside = checkpointed(listed.select("h1", "h2").distinct())
    outside = checkpointed(universe.select("h1", "h2").distinct().join(inside, ["h1", "h2"], "left_anti"))
    levels: list[tuple[np.ndarray, int]] = []
    encode, other, n = inside, outside, inside.count()
    while n:
        bits = max(64, n * BITS_PER_KEY)
        words = _level(encode, len(levels) + 1, bits)
        wrong = _passing(other, words, len(levels) + 1, bits)
        levels.append((words, bits))
        encode, other, n = wrong, encode, wrong.count()
    return levels


#: More false positives among the others than a level of ``BITS_PER_KEY`` lets through.
WRONG_SHARE = 0.04


def n_shares(n_listed: int, n_others: int, max_bits: int) -> int:
    """Into how many shares keys are dealt by hash, so that every level of each cascade keeps to ``max_bits``.

    The first level holds the listed keys, the second the others that it gets wrong, a share of them; the
    levels after these are smaller.  Twice the expected bits are asked for, since shares differ.
    """
    return max(1, -(-2 * BITS_PER_KEY * max(n_listed, math.ceil(WRONG_SHARE * n_others)) // max_bits))


def in_cascade(df: DataFrame, levels: list[tuple[np.ndarray, int]]) -> DataFrame:
    """Add ``listed`` to rows with h1, h2: the first level that misses a key decides."""
    held = df.sparkSession.sparkContext.broadcast(levels)

    @F.pandas_udf("boolean")
    def member(h1: pd.Series, h2: pd.Series) -> pd.Series:
        a, b = h1.to_numpy(np.int64).view(np.uint64), h2.to_numpy(np.int64).view(np.uint64)
        out = np.zeros(len(a), dtype=bool)
        left = np.arange(len(a))
        for level, (words, bits) in enumerate(held.value, 1):
            hit = _passes(words, _positions(a[left], b[left], level, bits))
            left = left[hit]
            out[left] = level % 2 == 1
        return pd.Series(out)

    return df.withColumn("listed", member("h1", "h2"))


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES, url_col: str = "url", max_bits: int = MAX_BITS) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``listed`` and ``verdict`` to every page.

    ``listed``: DataFrame of column ``key`` (host + path).  The longest fitting
    rule decides; without one the cascade blocks listed keys and allows the
    rest.  The key universe is that of ``pages``, for which the cascade is
    exact.  Where the list, or the other keys that a level gets wrong, ask for
    more than ``max_bits``, keys are dealt into shares by hash and each share has a cascade of its own, so what is
    broadcast at once stays bounded; pages are read once for each share.  Null
    keys are the empty key; repeated pages share their verdicts; columns of the
    added names are replaced.
    """
    require(pages, url_col)
    require(listed, "key")
    added = ("host", "path", "rule", "listed", "verdict", "h1", "h2")
    host, path = split_url(F.col(url_col))
    rows = pages.drop(*added).withColumns({"host": host, "path": path})
    hashed = rows.select("*", *key_hashes(F.concat("host", "path")))
    names = checkpointed(listed.select(*key_hashes(F.coalesce("key", F.lit("")))).distinct())
    # about so many, which the room of the shares allows for
    n_keys = hashed.agg(F.approx_count_distinct("h1")).first()[0]
    shares = n_shares(names.count(), n_keys, max_bits)

    def of(df: DataFrame, k: int) -> DataFrame:
        return df if shares == 1 else df.filter(F.pmod("h1", F.lit(shares)) == k)

    parts = [in_cascade(of(hashed, k), build_cascade(of(hashed, k), of(names, k))) for k in range(shares)]
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    fallback = F.when(F.col("listed"), "block").otherwise("allow")
    return reduce(DataFrame.unionByName, parts).withColumns({"rule": rule, "verdict": F.coalesce(verdict, fallback)}).drop("h1", "h2")
