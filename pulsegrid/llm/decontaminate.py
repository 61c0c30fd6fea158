"""Benchmark decontamination with one Aho-Corasick automaton."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_stored, require, stored, stored_paths

#: Fixed pattern: words of a text as given; A-Z counts as a-z.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: UTF-8 bytes: A-Z lower-cased, what is no part of a word as a space.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WINDOW = 13
#: An automaton and its windows take up to about 80 times this in a worker.
BLOCK_BYTES = 4 << 20

ADDED = "n_words long, hits array<int>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TABLE).split()


def joined(words: list[bytes]) -> str:
    """The words, each with a space on either side."""
    return f" {b' '.join(words).decode()} "


class Matcher:
    """Finds the windows that documents share with the items.

    The automaton holds each item's words once, in aligned blocks of
    (window + 1) / 2 words: any window covers a whole block, so a document's
    windows are looked up, by 128-bit hashes, only around a block's hit.  An
    item of fewer words than a window is a block and a window of its own.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.size = (window + 1) // 2
        self.window = window
        self.automaton = ahocorasick.Automaton()
        self.short: dict[str, set[str]] = {}
        #: An item's name, or those of several items.
        self.windows: dict[bytes, str | frozenset[str]] = {}
        for name, words in items:
            if len(words) < window:
                if words:
                    self.short.setdefault(joined(words), set()).add(name)
                continue
            for start in range(0, len(words) - self.size + 1, self.size):
                self.automaton.add_word(joined(words[start : start + self.size]), self.size)
            for start in range(len(words) - window + 1):
                key = self._key(words[start : start + window])
                if (held := self.windows.setdefault(key, name)) != name:
                    self.windows[key] = (held if isinstance(held, frozenset) else frozenset([held])) | {name}
        for key in self.short:
            # where a short item is a block, too, both are looked up
            self.automaton.add_word(key, -key.count(" ") + 1 if key not in self.automaton else 0)
        self.ready = len(self.automaton) > 0
        if self.ready:
            self.automaton.make_automaton()

    @staticmethod
    def _key(words: list[bytes]) -> bytes:
        return xxhash.xxh3_128_digest(b" ".join(words))

    def runs(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(first word, word after the last) of the windows in a text's words, and the items they are of."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        if not self.ready:
            return spans, items
        norm = joined(words)
        hits = list(self.automaton.iter(norm))
        if not hits:
            return spans, items
        gaps = np.flatnonzero(np.frombuffer(norm.encode("utf-32-le"), dtype=np.uint32) == 32)
        ends = np.searchsorted(gaps, [e for e, _ in hits])
        tried = 0
        for (_, kind), after in zip(hits, ends.tolist(), strict=True):
            if kind <= 0:
                n = -kind or self.size
                if found := self.short.get(joined(words[after - n : after])):
                    spans.append((after - n, after))
                    items |= found
            if kind >= 0:
                last = min(after - self.size, len(words) - self.window)
                for i in range(max(tried, after - self.window, 0), last + 1):
                    if (found := self.windows.get(self._key(words[i : i + self.window]))) is not None:
                        spans.append((i, i + self.window))
                        items |= {found} if isinstance(found, str) else found
                tried = max(tried, last + 1)
        return spans, items


#: The automaton that a worker has built last, by the block it is of.
_BUILT: dict[str, Matcher] = {}


def _matcher(name: str, block: list[tuple[str, list[bytes]]], window: int) -> Matcher:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Matcher(block, window)
    return _BUILT[name]


def _merged(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list[tuple[str, list[bytes]]], bool]]:
    """The items in blocks of bounded bytes, so the automaton's size is bounded too, and whether more come."""
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        block = sorted({(r.i, tuple(words_of(r.t))) for r in part.collect()})
        yield [(i, list(w)) for i, w in block], k < n - 1


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add to every document:

    * ``n_words``; ``hits``: merged runs of hit words, as flat word numbers
      (start, end, start, end, ...); ``items``: ids of the items with runs,
      sorted as strings; ``spans``: the runs in code points of the given text.

    An item of fewer words than ``window`` is one window; items and documents
    without words hit nothing; null counts as empty, a null item id as the id
    ``""``; columns of the added names are replaced.  Documents are scanned in
    place, without a shuffle, once for each block of items (one block up to
    ``block_bytes`` of item text).  Blocks are taken one after the other: what
    a block hits is stored before the next one is read and broadcast.
    """
    require(docs, text_col)
    require(benchmark, item_col, item_text_col)
    docs = docs.drop("n_words", "hits", "items", "spans")
    fields = T.StructType(docs.schema.fields + T._parse_datatype_string(ADDED).fields)
    spark = docs.sparkSession
    out, before = docs, set()
    blocks = item_blocks(benchmark, item_col, item_text_col, block_bytes)
    for turn, (block, more) in enumerate(blocks):
        held = spark.sparkContext.broadcast(block)

        def scan(parts: Iterator[pd.DataFrame], held=held, name=uuid.uuid4().hex, first=turn == 0) -> Iterator[pd.DataFrame]:
            matcher = _matcher(name, held.value, window)
            for pdf in parts:
                n_words, hits, items = [], [], []
                for k, text in enumerate(pdf[text_col].tolist()):
                    words = words_of(text)
                    n_words.append(len(words))
                    runs, found = matcher.runs(words)
                    old = [] if first else list(pdf["hits"].iat[k])
                    hits.append(_merged(runs + list(zip(old[::2], old[1::2], strict=True))))
                    items.append(sorted(found | set([] if first else pdf["items"].iat[k])))
                yield pdf.assign(n_words=n_words, hits=hits, items=items)[fields.names]

        out = out.mapInPandas(scan, fields)
        if more:
            known = stored_paths()
            out = stored(out)
            held.destroy()
            drop_stored(spark, before)
            before = stored_paths() - known
    return out.withColumn("spans", F.pandas_udf(original_spans, "array<struct<start:int,end:int>>")(text_col, "hits"))


def original_spans(text: pd.Series, hits: pd.Series) -> pd.Series:
    """Word runs as code-point spans of the text as given."""
    out = []
    for t, h in zip(text.tolist(), hits.tolist(), strict=True):
        if h is None or not len(h):
            out.append([])
            continue
        at = [m.span() for m in WORD.finditer(t or "")]
        out.append([{"start": at[a][0], "end": at[b - 1][1]} for a, b in zip(h[::2], h[1::2], strict=True)])
    return pd.Series(out)


def contamination(found: DataFrame) -> DataFrame:
    """Add ``n_hit`` and ``contaminated`` (a twentieth of the words or more are hit)."""
    n_hit = F.aggregate("hits", F.struct(F.lit(1).alias("sign"), F.lit(0).cast("long").alias("n")), lambda acc, x: F.struct((-acc["sign"]).alias("sign"), (acc["n"] - acc["sign"] * x).alias("n")), lambda acc: acc["n"])
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
