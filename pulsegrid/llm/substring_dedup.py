"""Repeated byte strings, found by a depth-limited radix sort of suffixes."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import require, stored

THRESHOLD = 200
#: Contexts of one anchor string that a task sorts; beyond, windows are grouped by Spark.
MOST_CONTEXTS = 20_000
CHUNK = 1 << 19
#: Contexts that a task turns into rows, or begins to sort, at once.
SLICE = 5_000
DIGITS = 4

_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, b, dtype=np.uint64)
        p[:1] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def _named(raw: bytes) -> tuple[int, int]:
    """A byte string's name: 96 bits of BLAKE2b, of which no texts can be made that share them."""
    h = blake2b(raw, digest_size=12).digest()
    return int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)


def _names(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.array([_named(r) for r in raws], dtype=np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1].astype(np.int32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _sliding(op: np.ufunc, a: np.ndarray, w: int, fill: int) -> np.ndarray:
    """``op`` (minimum or maximum) over a[i : i + w] for every i, padded with ``fill``."""
    n = len(a)
    size = -(-(n + w - 1) // w) * w
    padded = np.full(size, fill, dtype=np.uint64)
    padded[:n] = a
    blocks = padded.reshape(-1, w)
    ahead = op.accumulate(blocks, axis=1).ravel()
    behind = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(behind[:n], ahead[w - 1 : w - 1 + n])


class Anchors:
    """Chooses places in texts by their content alone.

    In every window of ``threshold`` bytes the smallest hash of ``k`` bytes
    marks an anchor, so equal windows have equal anchors at equal distances,
    and only one of about (threshold - k) / 2 suffixes needs to be moved.
    """

    def __init__(self, threshold: int) -> None:
        self.threshold = threshold
        self.k = max(1, threshold * 11 // 25)
        self.reach = threshold - self.k
        self.up, self.down = _powers(CHUNK + 8 * threshold + 1)

    def pieces(self, raw: bytes) -> Iterator[tuple[int, int, int, int]]:
        """(from, to, first own place, end of own places) of pieces of bounded size."""
        n, margin = len(raw), 2 * self.threshold
        if n <= CHUNK:
            yield 0, n, 0, n
            return
        for at in range(0, n, CHUNK):
            yield max(0, at - margin), min(n, at + CHUNK + margin), at, min(n, at + CHUNK)

    def find(self, raws: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, place, bytes before, bytes after, anchor hash, context name) in arrays.

        Anchor hashes only bring places together; contexts are named by their bytes.
        """
        held: list[tuple[int, bytes, int, int, int]] = []
        size = 0
        for row, raw in enumerate(raws):
            if len(raw) < self.threshold:
                continue
            for a, b, own, end in self.pieces(raw):
                if held and size + b - a > CHUNK + 4 * self.threshold:
                    yield self._chunk(held)
                    held, size = [], 0
                held.append((row, raw[a:b], a, own, end))
                size += b - a
        if held:
            yield self._chunk(held)

    def _chunk(self, held: list[tuple[int, bytes, int, int, int]]) -> tuple[np.ndarray, ...]:
        k, w, t = self.k, self.reach + 1, self.threshold
        buf = np.frombuffer(b"".join(h[1] for h in held), dtype=np.uint8)
        n = len(buf)
        sizes = np.array([len(h[1]) for h in held])
        ends = np.cumsum(sizes)
        end = np.repeat(ends, sizes)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[buf] * self.down[:n], out=sums[1:])
        at = np.arange(n)
        grams = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
        if n >= k:
            grams[: n - k + 1] = _mixed((sums[k:] - sums[: n - k + 1]) * self.up[: n - k + 1])
        grams[at + k > end] = np.iinfo(np.uint64).max
        least = _sliding(np.minimum, grams, w, np.iinfo(np.uint64).max)
        least[at + t > end] = 0
        # the greatest of the least hashes of the windows that hold a place
        most = _sliding(np.maximum, least[::-1], w, 0)[::-1]
        place = np.flatnonzero(most == grams)
        place = place[place + k <= end[place]]
        piece = np.searchsorted(ends, place, side="right")
        begin = (ends - sizes)[piece]
        lo, hi = np.maximum(begin, place - self.reach), np.minimum(ends[piece], place + t)
        own = place - begin + np.array([h[2] for h in held])[piece]
        keep = (own >= np.array([h[3] for h in held])[piece]) & (own < np.array([h[4] for h in held])[piece])
        row = np.array([h[0] for h in held])[piece]
        row, own, place, lo, hi = (x[keep] for x in (row, own, place, lo, hi))
        raw = buf.tobytes()
        names = _names([raw[a:b] + (c - a).to_bytes(4, "little") for a, b, c in zip(lo.tolist(), hi.tolist(), place.tolist(), strict=True)])
        return row, own, place - lo, hi - place, grams[place].view(np.int64), *names


def anchors(docs: DataFrame, threshold: int) -> DataFrame:
    """(anchor, context, check, doc, tag, place, before, after) over all texts; context and check name the bytes around."""

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Anchors(threshold)
        for pdf in parts:
            doc, tag = pdf["doc"].astype("Int64").array, pdf["tag"].to_numpy(np.int64)
            for row, place, before, after, anchor, context, check in finder.find([(x or "").encode() for x in pdf["text"].tolist()]):
                yield pd.DataFrame({"anchor": anchor, "context": context, "check": check, "doc": doc.take(row), "tag": tag[row], "place": place, "before": before, "after": after})

    return docs.mapInPandas(scan, "anchor long, context long, check int, doc long, tag long, place long, before int, after int")


def _contexts(docs: DataFrame, edges: DataFrame, threshold: int) -> DataFrame:
    """The bytes around the anchors that are still open."""
    per_doc = edges.groupBy("doc", "tag").agg(F.collect_list(F.struct("anchor", "place", "alone")).alias("open"))
    same = docs["doc"].eqNullSafe(per_doc["doc"]) & (docs["tag"] == per_doc["tag"])
    reach = Anchors(threshold).reach
    names = ["anchor", "place", "alone"]

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            row = np.repeat(np.arange(len(pdf)), pdf["place"].map(len).to_numpy(np.int64))
            whole = {n: np.concatenate(pdf[n].to_list()) for n in names}
            doc, tag, texts = pdf["doc"].astype("Int64").array, pdf["tag"].to_numpy(np.int64), pdf["text"].to_list()
            last, raw = -1, b""
            for at in range(0, len(row), SLICE):
                rows, out = row[at : at + SLICE], {n: v[at : at + SLICE] for n, v in whole.items()}
                held = []
                for i, place in zip(rows.tolist(), out["place"].tolist(), strict=True):
                    if i != last:
                        last, raw = i, texts[i].encode()
                    held.append(raw[max(place - reach, 0) : place + threshold])
                yield pd.DataFrame(out | {"doc": doc.take(rows), "tag": tag[rows], "before": np.minimum(out["place"], reach), "bytes": held})

    joined = docs.join(per_doc, same).select(docs["doc"], docs["tag"], "text", *[F.col(f"open.{n}").alias(n) for n in names])
    return joined.mapInPandas(cut, "anchor long, doc long, tag long, place long, alone boolean, before int, bytes binary")


class _Matrix:
    """Contexts laid side by side, their anchors in one column."""

    def __init__(self, pdf: pd.DataFrame, threshold: int) -> None:
        self.reach = Anchors(threshold).reach
        self.threshold = threshold
        width = self.reach + threshold
        self.before = pdf["before"].to_numpy(np.int64)
        self.after = pdf["bytes"].map(len).to_numpy(np.int64) - self.before
        padded = [(bytes(self.reach - b) + raw).ljust(width, b"\0") for b, raw in zip(self.before.tolist(), pdf["bytes"], strict=True)]
        self.cells = cells = np.frombuffer(b"".join(padded), dtype=np.uint8).reshape(len(pdf), width)
        self.up, down = _powers(width + 1)
        self.sums = np.zeros((len(pdf), width + 1), dtype=np.uint64)
        for at in range(0, len(pdf), 1000):
            self.sums[at : at + 1000, 1:] = _BYTE[cells[at : at + 1000]] * down[:width]
        np.cumsum(self.sums, axis=1, out=self.sums)

    def valid(self, d: int) -> np.ndarray:
        return np.flatnonzero((self.before >= d) & (self.after >= self.threshold - d))

    def digit(self, rows: np.ndarray, d: int, j: int, digits: int) -> np.ndarray:
        """Digit j of the window that starts d bytes before the anchor."""
        a = self.reach - d + self.threshold * j // digits
        b = self.reach - d + self.threshold * (j + 1) // digits
        return (self.sums[rows, b] - self.sums[rows, a]) * self.up[a]


    def digit_bytes(self, rows: np.ndarray, d: int, j: int, digits: int) -> np.ndarray:
        """The same digit as numbers that differ where its bytes do, by sorting them."""
        a = self.reach - d + self.threshold * j // digits
        b = self.reach - d + self.threshold * (j + 1) // digits
        raw = np.ascontiguousarray(self.cells[rows, a:b])
        return np.unique(raw.view(f"V{b - a}").ravel(), return_inverse=True)[1].astype(np.uint64)

    def equal(self, rows: np.ndarray, others: np.ndarray, d: np.ndarray) -> bool:
        """Whether the windows d bytes before the anchors have the same bytes, row by row."""
        for at in range(0, len(rows), 2_000):
            place = (self.reach - d[at : at + 2_000])[:, None] + np.arange(self.threshold)
            if not np.array_equal(self.cells[rows[at : at + 2_000, None], place], self.cells[others[at : at + 2_000, None], place]):
                return False
        return True


def _sorted_windows(pdf: pd.DataFrame, threshold: int) -> pd.DataFrame:
    """Spans of the windows that some other context of the same anchor also has.

    For each distance d from the anchor the suffixes are dealt into groups by
    their most significant digit, the groups by the next digit, and so on to
    ``threshold`` bytes; groups of one are left at once.  Digits are told apart
    by hashes; the bytes of the windows that bound a span are compared after
    it, and where some differ all digits are told apart by their bytes.
    """
    m = _Matrix(pdf, threshold)
    code = pd.factorize(pdf["anchor"])[0].astype(np.uint64)
    for hashed in (True, False):
        near, far = np.full(len(pdf), -1), np.full(len(pdf), -1)
        pair = np.zeros((2, len(pdf)), dtype=np.int64)
        for d in range(m.reach + 1):
            rows = m.valid(d)
            group = code[rows]
            for j in range(DIGITS):
                if not len(rows):
                    break
                digit = _mixed(m.digit(rows, d, j, DIGITS)) if hashed else m.digit_bytes(rows, d, j, DIGITS)
                whole = _mixed(group * _U(_BASE) + _U(1)) ^ digit if hashed else group * _U(len(pdf) + 1) + digit
                _, group, count = np.unique(whole, return_inverse=True, return_counts=True)
                keep = count[group] > 1
                rows, group = rows[keep], group[keep].astype(np.uint64)
            if not len(rows):
                continue
            # the first of a group stands for it, and the last one for the first
            _, first, group = np.unique(group, return_index=True, return_inverse=True)
            last = np.zeros(len(first), dtype=np.int64)
            last[group] = np.arange(len(rows))
            other = np.where(rows == rows[first][group], rows[last][group], rows[first][group])
            new = near[rows] < 0
            pair[0, rows[new]] = other[new]
            pair[1, rows] = other
            near[rows[new]] = d
            far[rows] = d
        hit = np.flatnonzero((far >= 0) & pdf["alone"].to_numpy(bool))
        if not hashed or (m.equal(hit, pair[0, hit], near[hit]) and m.equal(hit, pair[1, hit], far[hit])):
            break
    # all windows of a context hold its anchor, so their union is one span
    out = pdf.iloc[hit][["doc", "tag"]]
    place = pdf["place"].to_numpy(np.int64)[hit]
    return out.assign(start=place - far[hit], end=place - near[hit] + threshold)


def _by_task(contexts: DataFrame, threshold: int) -> DataFrame:
    """Radix sort of the contexts of each anchor, some thousand contexts at a time."""

    def sort(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for pdf in parts:
            at = 0
            cuts = [*(np.flatnonzero(np.diff(pdf["anchor"].to_numpy())) + 1), None]
            for cut in cuts:
                if cut is None:
                    held.append(pdf.iloc[at:])
                    size += len(pdf) - at
                elif size + cut - at >= SLICE:
                    held.append(pdf.iloc[at:cut])
                    yield _sorted_windows(pd.concat(held, ignore_index=True), threshold)
                    held, size, at = [], 0, int(cut)
        if size:
            yield _sorted_windows(pd.concat(held, ignore_index=True), threshold)

    dealt = contexts.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInPandas(sort, "doc long, tag long, start long, end long")


def _by_window(contexts: DataFrame, threshold: int) -> DataFrame:
    """The same for anchors of very many contexts: windows are counted by Spark, pre-aggregated."""

    def windows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in parts:
            for at in range(0, len(whole), 2000):
                pdf = whole.iloc[at : at + 2000]
                m = _Matrix(pdf, threshold)
                for d in range(m.reach + 1):
                    if len(rows := m.valid(d)):
                        some = pdf.iloc[rows]
                        at = m.reach - d
                        h1, h2 = _names([m.cells[r, at : at + threshold].tobytes() for r in rows.tolist()])
                        yield pd.DataFrame({"anchor": some["anchor"], "d": d, "h1": h1, "h2": h2, "doc": some["doc"].astype("Int64"), "tag": some["tag"], "start": some["place"] - d, "alone": some["alone"]})

    key = ["anchor", "d", "h1", "h2"]
    rows = contexts.mapInPandas(windows, "anchor long, d int, h1 long, h2 int, doc long, tag long, start long, alone boolean")
    twice = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key)
    hit = rows.filter("alone").join(twice, key).groupBy("doc", "tag", "anchor", (F.col("start") + F.col("d")).alias("place"))
    return hit.agg(F.min("start").alias("start"), (F.max("start") + threshold).alias("end")).select("doc", "tag", "start", "end")


def repeated_spans(docs: DataFrame, threshold: int, most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """(doc, tag, start, end): spans that cover exactly the repeated windows, overlapping."""
    found = anchors(docs, threshold)
    again = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    open_ = stored(found.join(again.hint("merge"), "anchor"))
    # Whole contexts first: where one repeats, so do all its windows.
    contexts = open_.groupBy("anchor", "context", "check").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "tag", "place")).alias("one"))
    contexts = stored(contexts)
    inside = open_.join(contexts.filter("n > 1").select("anchor", "context", "check").hint("merge"), ["anchor", "context", "check"])
    inside = inside.select("doc", "tag", (F.col("place") - F.col("before")).alias("start"), (F.col("place") + F.col("after")).alias("end"))
    # What is left are contexts of their own, to be sorted with one of each other context.
    mixed = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n_contexts"), F.bool_or(F.col("n") == 1).alias("some")).filter("some and n_contexts > 1")
    edges = contexts.join(mixed.hint("merge"), "anchor").select("anchor", "one.*", (F.col("n") == 1).alias("alone"), "n_contexts")
    few = edges.filter(F.col("n_contexts") <= most_contexts)
    found = inside.unionByName(_by_task(_contexts(docs, few, threshold), threshold))
    if mixed.filter(F.col("n_contexts") > most_contexts).isEmpty():
        return found
    many = _contexts(docs, edges.filter(F.col("n_contexts") > most_contexts), threshold)
    return found.unionByName(_by_window(many, threshold))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """One row per input row: the id, ``n_bytes``, ``spans`` and ``kept``.

    A byte goes if a string of ``threshold`` bytes over it also starts anywhere
    else in the corpus, overlapping or in the same text included; strings never
    cross texts.  ``spans``: maximal removed runs (byte offsets, end
    exclusive); ``kept``: the other bytes, as binary since a cut may fall
    inside a character.  Null counts as empty.  Ids are integers.  Rows of one
    id, or of null ids, are told apart by a 64-bit hash of their texts; rows
    equal in both are copies of each other.
    """
    require(docs, id_col, text_col)
    if threshold < 8:
        raise ValueError("threshold must be 8 bytes or more")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("tag"), text.alias("text"))
    spans = repeated_spans(keyed, threshold, most_contexts)
    per_doc = spans.groupBy("doc", "tag").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("found"))
    same = keyed["doc"].eqNullSafe(per_doc["doc"]) & (keyed["tag"] == per_doc["tag"])
    joined = keyed.join(per_doc, same, "left").select(keyed["doc"], "text", F.col("found.start").alias("starts"), F.col("found.end").alias("ends"))

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            merged, kept, n_bytes = [], [], []
            for text, starts, ends in zip(pdf["text"], pdf["starts"], pdf["ends"], strict=True):
                raw = text.encode()
                n_bytes.append(len(raw))
                if starts is None:
                    merged.append([])
                    kept.append(raw)
                    continue
                until = np.maximum.accumulate(ends)
                new = np.flatnonzero(starts[1:] > until[:-1]) + 1
                a, b = starts[np.concatenate([[0], new])], until[np.concatenate([new - 1, [len(until) - 1]])]
                merged.append([{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
                kept.append(b"".join(raw[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(raw)], strict=True)))
            yield pd.DataFrame({"doc": pdf["doc"].astype("Int64"), "n_bytes": n_bytes, "spans": merged, "kept": kept})

    out = joined.mapInPandas(cut, "doc long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return out.withColumnRenamed("doc", id_col)
