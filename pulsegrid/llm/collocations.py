"""Phrase collocations from counts of padded longest windows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bit_filter, in_filter, require, stored

#: Bytes of text that a task takes apart at once.
CHUNK = 1 << 22
_END = b"\xff"  # stands in no UTF-8 text
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + _END * 10)
_CUT = re.compile(rb"[ \t.,;:!?\n-\r]")
_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _slices(raws: list[bytes]) -> Iterator[tuple[bytes, bool]]:
    """The texts in slices of about ``CHUNK`` bytes, and whether the slice ends with its text."""
    held, size = [], 0
    for raw in raws:
        if size + len(raw) > CHUNK and held:
            yield _END.join(held), True
            held, size = [], 0
        at = 0
        while len(raw) - at > CHUNK and (cut := _CUT.search(raw, at + CHUNK)):
            yield raw[at : cut.end()], False
            at = cut.end()
        held.append(raw[at:])
        size += len(raw) - at
    if held:
        yield _END.join(held), True


def _words(raws: list[bytes], longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(codes, words, own): words in order as codes into the distinct ones, -1 between pieces.

    Windows start at the first ``own`` words.  The others, which a longest window of a slice could go
    beyond, are only seen from there, and open the next slice.
    """
    late: list[bytes] = []
    for raw, whole in _slices(raws):
        found = late + raw.translate(_FOLD).replace(_END, b" " + _END + b" ").split()
        own = len(found)
        while not whole and own and len(found) - own < longest - 1 and found[own - 1] != _END:
            own -= 1
        late = found[own:]
        if own:
            codes, words = pd.factorize(np.array(found, dtype=object))
            yield np.where((words == _END)[codes], -1, codes), words, own


def _by_language(parts: Iterator[pd.DataFrame], longest: int) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray, int]]:
    """(lang, codes, words, hashes of lang and words in order, own) of chunks of one language each."""
    for pdf in parts:
        for lang, texts in pdf.groupby("lang")["text"]:
            salt = pd.util.hash_array(np.array([lang], dtype=object), categorize=False) * _MIX
            for codes, words, own in _words([x.encode() for x in texts], longest):
                yield lang, codes, words, ((pd.util.hash_array(words, categorize=False) ^ salt) * _MIX)[codes], own


class _Frequent:
    """Where phrases of 1, 2, ... words may be frequent, by a bit filter of hashed phrases for each size."""

    def __init__(self, filters: list) -> None:
        self.filters = filters

    def marks(self, codes: np.ndarray, hashes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """(places where phrases of each size known may be frequent; places of the next size, all whose
        parts may be frequent, and its hashes)."""
        out: list[np.ndarray] = []
        open_, phrase = codes >= 0, hashes
        for k, words in enumerate(self.filters):
            some = open_.copy()
            some[open_] = in_filter(words.value, phrase[open_].view(np.int64))
            out.append(some)
            open_ = some & np.append(some[1:], False)
            phrase = (phrase * _MIX2) ^ (np.append(hashes[k + 1 :], np.zeros(min(k + 1, len(hashes)), dtype=np.uint64)) >> np.uint64(1))
        return out, open_, phrase

    def runs(self, codes: np.ndarray, hashes: np.ndarray, longest: int) -> np.ndarray:
        """How many words from each place on may stand in a frequent phrase, itself at least, ``longest`` at most."""
        marks, _, _ = self.marks(codes, hashes)
        out = np.zeros(len(codes), dtype=np.int64)
        for k in range(longest):
            if k < len(marks):
                on = marks[k]
            else:
                ahead = k + 1 - len(marks)
                on = on & np.append(marks[-1][ahead:], np.zeros(min(ahead, len(codes)), dtype=bool))
            out += on
        return np.maximum(out, codes >= 0)


def _next_filter(texts: DataFrame, longest: int, least: int, known: _Frequent):
    """The bit filter of the phrases one word longer than ``known`` has, of ``least`` occurrences or more."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, codes, _, hashes, own in _by_language(parts, longest):
            _, open_, phrase = known.marks(codes, hashes)
            h, n = np.unique(phrase[:own][open_[:own]], return_counts=True)
            yield pd.DataFrame({"h": h.view(np.int64), "n": n})

    found = texts.mapInPandas(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return bit_filter(stored(found.filter(F.col("n") >= least).select("h")), "h")


def _rows_of(codes: np.ndarray, run: np.ndarray, own: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows of the first ``own`` places, a row of ``longest`` codes padded with -1 each, and their counts."""
    places = np.flatnonzero(codes[:own] >= 0)
    group = codes[places] * 0
    base = len(codes) + 2
    for k in range(longest):  # windows are told apart column by column
        some = np.flatnonzero(run[places] > k)
        if not len(some):
            break
        value = np.full(len(places), -1)
        value[some] = codes[places[some] + k]
        _, group = np.unique(group * base + value + 1, return_inverse=True)
    _, first, n = np.unique(group, return_index=True, return_counts=True)
    at = places[first]
    cells = np.full((len(at), longest), -1)
    for k in range(longest):
        some = np.flatnonzero(run[at] > k)
        cells[some, k] = codes[at[some] + k]
    return cells, n


def longest_windows(texts: DataFrame, longest: int, least: int, told_by: int = 3) -> DataFrame:
    """(lang, w1, ..., n): windows of ``longest`` words that start at every word, counted.

    A window holds its first word.  It is padded with nulls from the end of its piece on, and from where
    a phrase of up to ``told_by`` words in it occurs fewer than ``least`` times, since no frequent phrase
    goes beyond it.
    Bit filters of hashed phrases, one pass over the texts each, tell that; what they let through
    beyond it is only counted in vain.
    """
    known = _Frequent([])
    for _ in range(min(told_by, longest)):
        known = _Frequent([*known.filters, _next_filter(texts, longest, least, known)])
    names = [f"w{k + 1}" for k in range(longest)]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, codes, words, hashes, own in _by_language(parts, longest):
            cells, n = _rows_of(codes, known.runs(codes, hashes, longest), own, longest)
            used = np.unique(cells)
            said = np.full(len(words) + 1, None, dtype=object)
            for c in used[used >= 0].tolist():
                said[c] = words[c].decode()
            yield pd.DataFrame({"lang": lang, **{name: said[cells[:, k]] for k, name in enumerate(names)}, "n": n})

    return texts.mapInPandas(run, f"lang string, {', '.join(f'{w} string' for w in names)}, n long")


def phrase_counts(windows: DataFrame, longest: int, least: int) -> DataFrame:
    """(lang, k, phrase, f): phrases of k words with f >= ``least``; k = 0 has the words of a language.

    One ROLLUP over the columns of the counted windows: each sum over a shorter prefix counts the
    phrases that the prefix holds.
    """
    names = [f"w{k + 1}" for k in range(longest)]
    counted = windows.groupBy("lang", *names).agg(F.sum("n").alias("n"))
    sums = counted.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("rolled"))
    k = F.lit(longest) - F.length(F.replace(F.bin("rolled"), F.lit("0"), F.lit("")))
    last = F.get(F.array(F.lit(""), *names), F.col("k"))
    rows = sums.withColumn("k", k.cast("int")).filter((F.col("k") >= 0) & last.isNotNull() & ((F.col("k") == 0) | (F.col("f") >= least)))
    return rows.select("lang", "k", F.concat_ws(" ", *names).alias("phrase"), "f")


def _part(start: Column, size: Column) -> Column:
    return F.array_join(F.slice("words", start, size), " ")


def _weakest_cuts(phrases: DataFrame) -> DataFrame:
    """Candidates with the cut of the lowest score: l, r and score, floored, in exact decimals."""
    parts = phrases.filter("k > 0").select("lang", "phrase", "f")
    cuts = phrases.filter("k >= 2").withColumn("words", F.split("phrase", " ")).withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "k", F.col("f").alias("a"), "at", _part(F.lit(1), F.col("at")).alias("left"), _part(F.col("at") + 1, F.col("k") - F.col("at")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    totals = phrases.filter("k = 0").select("lang", F.col("f").alias("n"))
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    scored = cuts.join(totals, "lang").withColumn("score", score)
    best = scored.groupBy("lang", "phrase").agg(F.first("k").alias("k"), F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "at", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "k", "a", "n", "cut.l", "cut.r", "cut.score")


def mine_collocations(docs: DataFrame, longest: int = 5, least: int = 100, most: int = 2_000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to ``longest`` words of every language.

    Texts, A-Z lower-cased, are split at ``.,;:!?`` and line ends into pieces and those at spaces and
    tabs into words.  Phrases that occur a >= ``least`` times are candidates; of a candidate's cuts into
    two parts, which occur l and r times, the one with the least floor(1000 a n / (l r)) counts, the first
    of equal ones; n is the number of words of the language.  A candidate inside a longer one that occurs
    as often goes.  At most ``most`` a language stay, by score, count and phrase (bytes): a report.
    Null texts have no words, a null lang is ``und``; empty tables give no rows, repeated rows count each;
    no other column is read.
    """
    require(docs, text_col, lang_col)
    texts = docs.select(F.coalesce(lang_col, F.lit("und")).alias("lang"), F.coalesce(text_col, F.lit("")).alias("text"))
    phrases = stored(phrase_counts(stored(longest_windows(texts, longest, least)), longest, least))
    inner = phrases.filter("k >= 3").withColumn("words", F.split("phrase", " "))
    inner = inner.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1))).withColumn("start", F.explode(F.expr("sequence(1, k - size + 1)")))
    inside = inner.groupBy("lang", _part(F.col("start"), F.col("size")).alias("phrase")).agg(F.max("f").alias("longer"))
    alone = _weakest_cuts(phrases).join(inside, ["lang", "phrase"], "left").filter("longer is null or longer < a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = alone.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
