"""Near-duplicate lines by a deletion-neighbourhood join on words."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bit_filter, in_filter, require, row_tag, stored

MIN_WORDS = 8
REGIONS = 4
#: Bytes of text that a task takes apart at once.
CHUNK = 1 << 20

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_BACK = _U(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _running(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(x, dtype=np.uint64)])


def _base(n: np.ndarray) -> np.ndarray:
    """A length near n whose cuts a line of n words is given."""
    return np.where(n < 16, n, n // 8 * 8)


class Hashes:
    """Sums of hashes of (word, place) over some lines.

    Any stretch of a line is the difference of two sums, so the key of a line
    without a word, or without a region, takes a few steps whatever its length.
    """

    def __init__(self, lines: list[list[bytes]]) -> None:
        self.n = np.array([len(x) for x in lines], dtype=np.int64)
        self.end = np.cumsum(self.n)
        self.start = self.end - self.n
        total = int(self.n.sum())
        self.words = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(lines)), np.uint64, total)
        self.line = np.repeat(np.arange(len(lines)), self.n)
        self.at = np.arange(total) - self.start[self.line]
        self.front = _running(_mixed(self.words + self.at.astype(np.uint64) * _STEP))

    def region_keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(line, key, from, to): hashes of the lines without their words from..to-1.

        A line of about ``base`` words is cut into regions; an edit of one
        word lies in one of them and leaves what is before and after it as it
        was.  Lines of n and n + 1 words share a base.
        """
        back = _running(_mixed(self.words + (self.n[self.line] - 1 - self.at).astype(np.uint64) * _BACK))
        one, two = _base(self.n), _base(self.n - 1)
        more = np.flatnonzero(one != two)
        line, base = np.concatenate([np.arange(len(one)), more]), np.concatenate([one, two[more]])
        order = np.argsort(line, kind="stable")
        line, base = np.repeat(line[order], REGIONS), np.repeat(base[order], REGIONS)
        r = np.tile(np.arange(REGIONS), len(order))
        first, last = base * r // REGIONS, self.n[line] - base + base * (r + 1) // REGIONS
        s, e = self.start[line], self.end[line]
        ahead, behind = self.front[s + first] - self.front[s], back[e] - back[s + last]
        key = _mixed(_mixed(ahead + (base * REGIONS + r + 1).astype(np.uint64) * _STEP) + behind)
        return line, key.view(np.int64), first, last

    def variants(self, line: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, key, role) of the deletions in the given stretches, and of the whole lines.

        Role 0 names the place of the deleted word, so lines that share it
        differ by a substitution; role 1 does not, and meets the key of a
        whole line (role 2).
        """
        total = len(self.words)
        marks = np.zeros(total + 1, dtype=np.int64)
        np.add.at(marks, self.start[line] + first, 1)
        np.add.at(marks, self.start[line] + last, -1)
        place = np.flatnonzero(np.cumsum(marks[:total]) > 0)
        of = self.line[place]
        moved = _running(_mixed(self.words + (self.at - 1).astype(np.uint64) * _STEP))
        s, e = self.start[of], self.end[of]
        rest = self.front[place] - self.front[s] + moved[e] - moved[place + 1]
        whole = np.unique(of)
        keys = [_mixed(_mixed(rest) + (place - s + 1).astype(np.uint64) * _BACK), _mixed(rest), _mixed(self.front[self.end[whole]] - self.front[self.start[whole]])]
        roles = np.repeat([0, 1, 2], [len(k) for k in keys]).astype(np.int32)
        return np.concatenate([of, of, whole]), np.concatenate(keys).view(np.int64), roles


def within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether the edit distance of two word lists is 1 at most."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    p = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[p + (len(a) == len(b)) :] == b[p + 1 :]


class Lines:
    """The lines with words of some texts: text, line number, words, and an id of 128 bits."""

    def __init__(self, texts: list[tuple[int, bytes]]) -> None:
        rows, numbers, self.words = [], [], []
        for row, raw in texts:
            for number, line in enumerate(raw.split(b"\n")):
                if words := line.split():
                    rows.append(row)
                    numbers.append(number)
                    self.words.append(words)
        self.row, self.number = np.array(rows, dtype=np.int64), np.array(numbers, dtype=np.int32)
        self.said = [b" ".join(w) for w in self.words]
        self.ids = [xxhash.xxh3_128_digest(x) for x in self.said]
        self.half = np.frombuffer(b"".join(self.ids), dtype=np.int64)[::2]


def _scan(docs: DataFrame, each: Callable[[pa.RecordBatch, Lines], list], schema: str) -> DataFrame:
    """The batches that ``each`` makes of the lines of every chunk of texts."""
    names = [part.split()[0] for part in schema.split(", ")]

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            held, size = [], 0
            texts = batch.column("text")
            for row in range(len(texts)):
                raw = (texts[row].as_py() or "").encode()
                held.append((row, raw))
                size += len(raw)
                if size >= CHUNK or row + 1 == len(texts):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in each(batch, Lines(held))], names=names)
                    held, size = [], 0

    return docs.mapInArrow(scan, schema)


def line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc, tag, line, id, half, keys) of every line with words.

    ``keys``: region keys of lines long enough for near copies, once for equal
    lines of a chunk.
    """

    def each(batch: pa.RecordBatch, lines: Lines) -> list:
        once = dict(zip(reversed(lines.ids), range(len(lines.ids) - 1, -1, -1), strict=True))
        long = np.array(sorted(k for k in once.values() if len(lines.words[k]) >= min_words - 1), dtype=np.int64)
        line, key, _, _ = Hashes([lines.words[k] for k in long]).region_keys()
        sizes = np.zeros(len(lines.ids), dtype=np.int64)
        sizes[long] = np.bincount(line, minlength=len(long))
        keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(key))
        return [batch.column("doc").take(pa.array(lines.row)), batch.column("tag").take(pa.array(lines.row)), lines.number, lines.ids, lines.half, keys]

    return stored(_scan(docs, each, "doc long, tag binary, line int, id binary, half long, keys array<long>"))


def _place() -> Column:
    return F.struct("doc", "tag", "line")


def _flagged(table: DataFrame, shared_keys) -> DataFrame:
    """``half`` of the lines that share a region key with another line."""

    def test(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            keys = batch.column("keys")
            hit = _running(in_filter(shared_keys.value, keys.flatten().to_numpy()).astype(np.uint64))
            ends = keys.offsets.to_numpy() - keys.offsets[0].as_py()
            yield pa.RecordBatch.from_arrays([batch.column("half").filter(pa.array(hit[ends[1:]] > hit[ends[:-1]]))], names=["half"])

    return table.select("half", "keys").mapInArrow(test, "half long").distinct()


def _variants(docs: DataFrame, shared_keys, flagged, min_words: int) -> DataFrame:
    """(doc, tag, line, key, role, id, words): the variants of flagged lines in the regions where a neighbour can differ.

    The words stand beside whole lines (role 2) only.
    """

    def each(batch: pa.RecordBatch, lines: Lines) -> list:
        some = np.flatnonzero(in_filter(flagged.value, lines.half)) if len(lines.ids) else np.zeros(0, dtype=np.int64)
        doc, tag = batch.column("doc").to_pylist(), batch.column("tag").to_pylist()
        first: dict[bytes, tuple] = {}
        for k in some.tolist():
            if len(lines.words[k]) >= min_words - 1:
                i = lines.row[k]
                place = (doc[i] is not None, doc[i] or 0, tag[i], lines.number[k], k)
                first[lines.ids[k]] = min(place, first.get(lines.ids[k], place))
        some = np.array([x[-1] for x in first.values()], dtype=np.int64)
        hashes = Hashes([lines.words[k] for k in some])
        line, key, a, b = hashes.region_keys()
        hit = in_filter(shared_keys.value, key)
        line, key, role = hashes.variants(line[hit], a[hit], b[hit])
        of = some[line]
        ids = pa.array(lines.ids, pa.binary()).take(pa.array(of))
        said = pa.array(lines.said, pa.binary()).take(pa.array(np.where(role == 2, of, 0), mask=role != 2))
        return [batch.column("doc").take(pa.array(lines.row[of])), batch.column("tag").take(pa.array(lines.row[of])), lines.number[of], key, role, ids, said]

    return _scan(docs, each, "doc long, tag binary, line int, key long, role int, id binary, words binary")


def near_lines(docs: DataFrame, table: DataFrame, min_words: int) -> DataFrame:
    """Line ids that an earlier line is one word edit away from."""
    ends = table.select(F.explode("keys").alias("key"), "half")
    shared = stored(ends.groupBy("key").agg(F.min("half").alias("a"), F.max("half").alias("b")).filter("a <> b").select("key"))
    shared_keys = bit_filter(shared, "key")
    flagged = bit_filter(stored(_flagged(table, shared_keys)), "half")
    lines = stored(_variants(docs, shared_keys, flagged, min_words).withColumn("at", _place()).drop("doc", "tag", "line"))
    shared_keys.destroy()
    flagged.destroy()
    groups = (
        lines.groupBy("key")
        .agg(*[F.min(F.when(F.col("role") == r, F.struct("at", "id"))).alias(f"m{r}") for r in range(3)], F.min("id").alias("a"), F.max("id").alias("b"))
        .filter("a <> b")
    )
    partner = F.when(F.col("role") == 0, F.col("m0")).when(F.col("role") == 1, F.col("m2")).otherwise(F.col("m1"))
    pairs = lines.drop("words").join(groups.hint("merge"), "key").withColumn("p", partner).filter("p.at < at and p.id <> id")
    pairs = pairs.select("id", F.col("p.id").alias("other")).distinct()
    # the place of a copy is no reason to go: first places decide
    firsts = stored(lines.filter("role = 2").groupBy("id").agg(F.min("at").alias("at")))
    met = pairs.join(firsts, "id").join(firsts.select(F.col("id").alias("other"), F.col("at").alias("other_at")), "other")
    pairs = stored(met.filter("other_at < at").select("id", "other"))
    both_ends = stored(pairs.select(F.explode(F.array("id", "other")).alias("id")).distinct())
    # both ends of a pair are whole lines of the table of variants, so the texts need not be read again
    said = lines.filter("role = 2").select("id", "words").join(both_ends.hint("merge"), "id", "left_semi")
    said = stored(said.dropDuplicates(["id"]))
    both = pairs.join(said, "id").join(said.select(F.col("id").alias("other"), F.col("words").alias("other_words")), "other")

    def verified(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            split = [[x.split() for x in batch.column(c).to_pylist()] for c in ("words", "other_words")]
            good = [max(len(a), len(b)) >= min_words and within_one(a, b) for a, b in zip(*split, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id").filter(pa.array(good, pa.bool_()))], names=["id"])

    return both.select("id", "words", "other_words").mapInArrow(verified, "id binary").distinct()


def repeated_lines(docs: DataFrame, max_edits: int = 1, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, tag, lines): the numbers of the lines to remove from a document, sorted."""
    lines = line_table(docs, min_words)
    first = lines.groupBy("id").agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("n"))
    if max_edits:
        first = first.join(near_lines(docs, lines, min_words).withColumn("near", F.lit(True)), "id", "left")
    else:
        first = first.withColumn("near", F.lit(None).cast("boolean"))
    judged = first.filter("n > 1 or near").select("id", "first", F.coalesce("near", F.lit(False)).alias("near"))
    gone = lines.select("id", "doc", "tag", "line").join(judged.hint("merge"), "id").filter(F.col("near") | ~_place().eqNullSafe(F.col("first")))
    return gone.groupBy("doc", "tag").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def _without(text: pd.Series, gone: pd.Series) -> pd.Series:
    """The texts less the lines of the given numbers."""
    out = []
    for t, numbers in zip(text.tolist(), gone.tolist(), strict=True):
        if numbers is None:
            out.append(t)
            continue
        lines = np.array(t.split("\n"), dtype=object)
        lines[numbers] = None
        out.append("\n".join([x for x in lines.tolist() if x is not None]))
    return pd.Series(out)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_edits: int = 1, min_words: int = MIN_WORDS) -> DataFrame:
    """Remove from every text the lines that an earlier line repeats.

    Lines are compared by their words (runs without ASCII white space).  A line
    goes if an earlier one has the same words, or, with ``max_edits`` 1, if an
    earlier one is one inserted, deleted or substituted word away and the
    longer of both has ``min_words`` words: the bound is one word in eight,
    none in shorter lines.  Earlier: smaller id, then smaller line number; null
    ids come first.  Blank lines stay.  Adds ``n_lines`` (lines with words) and
    ``n_removed``; columns of these names are replaced.  Ids are integers.
    Null texts stay null.  Rows of one id are told apart by a 128-bit hash of
    their texts; rows equal in both share their verdicts.
    """
    require(docs, id_col, text_col)
    if max_edits not in (0, 1):
        raise ValueError("max_edits must be 0 or 1")
    if min_words < 4:
        raise ValueError("min_words must be 4 or more")
    kept = docs.drop("n_lines", "n_removed")
    keyed = docs.select(F.col(id_col).cast("long").alias("doc"), row_tag(F.col(text_col)).alias("tag"), F.col(text_col).alias("text"))
    gone = repeated_lines(keyed, max_edits, min_words).toDF("_gone_doc", "_gone_tag", "_gone_lines")
    match = kept[id_col].cast("long").eqNullSafe(F.col("_gone_doc")) & (row_tag(kept[text_col]) == F.col("_gone_tag"))
    joined = kept.join(gone, match, "left")
    lines, removed = F.split(F.col(text_col), "\n", -1), F.col("_gone_lines")
    n_lines = F.size(F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    # texts that stay as they are do not go through Python
    text = F.when(removed.isNull(), F.col(text_col)).otherwise(F.pandas_udf(_without, "string")(F.when(removed.isNotNull(), F.col(text_col)), removed))
    out = joined.withColumns({"n_lines": F.when(F.col(text_col).isNull(), 0).otherwise(n_lines).cast("long"), "n_removed": F.coalesce(F.size(removed), F.lit(0)).cast("long"), text_col: text})
    return out.select(*kept.columns, "n_lines", "n_removed")
