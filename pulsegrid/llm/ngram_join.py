"""Jaccard self-join of word n-grams with prefix filters under several global orders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bit_filter, drop_stored, in_filter, require, row_tag, stored, stored_paths
from .components import connected_components

WIDTH = 5
PERCENT = 80
ORDERS = 3
SKETCH_BITS = 20
BLOCK = 4096

_U = np.uint64
_STEP = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    x = x + _U((seed * _STEP) & ((1 << 64) - 1))
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


#: The bytes of an 8-byte number that a word of 0 to 8 bytes fills.
_FILLED = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text: eight bytes after eight, each mixed with what came before.

    Words of one length, eight bytes at most, never share a hash.
    """
    at_ends = np.frombuffer(b" " + raw + b" ", dtype=np.uint8)
    space = (at_ends == 0x20) | (at_ends - np.uint8(0x09) < np.uint8(5))
    edges = np.flatnonzero(space[1:] != space[:-1])
    at, end = np.ascontiguousarray(edges[::2]), edges[1::2]
    left = end - at
    eights = np.ndarray(len(raw), dtype="<u8", buffer=raw + bytes(8), strides=(1,))
    out = _mixed((eights[at] & _FILLED.take(left, mode="clip")) + left.astype(np.uint64) * _U(_STEP))
    more = np.flatnonzero(left > 8)
    at, left = at[more] + 8, left[more] - 8
    while len(more):
        out[more] = _mixed((eights[at] & _FILLED.take(left, mode="clip")) ^ out[more], 1)
        longer = np.flatnonzero(left > 8)
        more, at, left = more[longer], at[longer] + 8, left[longer] - 8
    return out


def shingles(text: str | None, width: int) -> np.ndarray:
    """64-bit hashes of the distinct shingles of a text, sorted.

    Each word has its own hash, and a shingle mixes those of its words in
    turn, so hashes follow no algebra of the letters.
    """
    each = word_hashes((text or "").encode().lower())
    if not len(each):
        return np.zeros(0, dtype=np.uint64)
    w = min(width, len(each))
    n = len(each) - w + 1
    out = np.full(n, w, dtype=np.uint64)
    for k in range(w):
        out = _mixed(out + each[k : k + n], k + 1)
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def class_of(tokens: np.ndarray) -> bytes:
    """128 bits that name a set; texts of equal sets are one class."""
    return xxhash.xxh3_128_digest(tokens.tobytes())


def _half(c: bytes) -> int:
    return int.from_bytes(c[:8], "big", signed=True)


def _sets(docs: DataFrame, width: int, emit, schema: str) -> DataFrame:
    """``emit(batch of (tokens, class))`` over the texts; copies in a task come once."""

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()
        for pdf in parts:
            batch, held = [], 0
            for text in pdf["text"].tolist():
                tokens = shingles(text, width)
                c = class_of(tokens)
                if len(tokens) and c not in seen:
                    seen.add(c)
                    batch.append((tokens, c))
                    held += len(tokens)
                if held > 400_000:
                    yield emit(batch)
                    batch, held = [], 0
            if batch:
                yield emit(batch)

    return docs.mapInPandas(scan, schema)


def _chosen(docs: DataFrame, some, *columns: str) -> DataFrame:
    """The texts of the rows whose hash of the columns is in a filter."""

    def chosen(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            yield batch.select(["text"]).filter(pa.array(in_filter(some.value, batch.column("key").to_numpy())))

    return docs.select("text", F.xxhash64(*columns).alias("key")).mapInArrow(chosen, "text string")


def measured(docs: DataFrame, width: int) -> tuple[DataFrame, np.ndarray]:
    """(doc, tag, class, n) of every text, and how often tokens fall in each cell of a sketch.

    The sketch orders tokens by frequency over all texts in bounded space:
    4 bytes a cell, whatever the corpus' size.
    """
    cells = 1 << SKETCH_BITS

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, total = set(), np.zeros(cells, dtype=np.int64)
        for pdf in parts:
            classes, sizes = [], []
            for text in pdf["text"].tolist():
                tokens = shingles(text, width)
                c = class_of(tokens)
                classes.append(c)
                sizes.append(len(tokens))
                if c not in seen:
                    seen.add(c)
                    # a set has few tokens of one cell
                    np.add.at(total, (tokens >> _U(64 - SKETCH_BITS)).astype(np.int64), 1)
            yield pd.DataFrame({"doc": pdf["doc"].astype("Int64"), "tag": pdf["tag"], "class": classes, "n": sizes, "block": -1, "slot": 0, "sums": None})
        blocks = np.minimum(total, (1 << 32) - 1).astype(np.uint32).reshape(-1, BLOCK)
        some = np.flatnonzero(blocks.any(axis=1))
        slot = TaskContext.get().partitionId() % 64
        yield pd.DataFrame({"doc": pd.array([None] * len(some), dtype="Int64"), "tag": None, "class": None, "n": 0, "block": some, "slot": slot, "sums": [blocks[i].tobytes() for i in some]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        sums = sum(np.frombuffer(x, dtype=np.uint32).astype(np.int64) for x in pdf["sums"])
        return pd.DataFrame({"block": [pdf["block"].iat[0]], "slot": [0], "sums": [np.minimum(sums, (1 << 32) - 1).astype(np.uint32).tobytes()]})

    schema = "block int, slot int, sums binary"
    both = stored(docs.mapInPandas(scan, f"doc long, tag binary, class binary, n long, {schema}"))
    parts = both.filter("block >= 0").select("block", "slot", "sums")
    whole = parts.groupBy("block", "slot").applyInPandas(add, schema).groupBy("block").applyInPandas(add, schema)
    out = np.zeros((cells // BLOCK, BLOCK), dtype=np.int64)
    for r in whole.collect():
        out[r.block] = np.frombuffer(r.sums, dtype=np.uint32)
    return both.filter("block < 0").select("doc", "tag", "class", "n"), out.ravel()


def _rarity(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(4 * np.log2(counts + 1.0)), 255).astype(np.uint8)


def prefix(tokens: np.ndarray, rarity: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first n - ceil(t n) + 1 tokens of a set of n under an order, in that order.

    An order goes by the frequency class of the token's cell, then by a hash
    that differs from order to order.  Sets at or above the similarity share a
    token of their prefixes, under any order.
    """
    n = len(tokens)
    size = n - -(-percent * n // 100) + 1
    rank = (rarity[(tokens >> _U(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << _U(56)) | (_mixed(tokens, order + 11) >> _U(8))
    if size < n:
        some = np.argpartition(rank, size - 1)[:size]
        tokens, rank = tokens[some], rank[some]
    return tokens[np.argsort(rank)]


def _may_link(n: str, i: str, m: str, j: str, percent: int) -> str:
    """Sets of n and m whose first common token stands at i and j have min(n - i, m - j) common ones at most."""
    return f"{100 + percent}L * least({n} - {i}, {m} - {j}) >= {percent}L * ({n} + {m})"


def prefixes(docs: DataFrame, rows: DataFrame, rarity: np.ndarray, width: int, percent: int) -> DataFrame:
    """(class, n, tokens): the prefix of every class under the first order, in that order, taken from one text of each.

    Other copies are not taken apart again, but for the few that a filter of the chosen rows lets through.
    """
    one = rows.filter("n > 0").groupBy("class").agg(F.min(F.struct("doc", "tag")).alias("one"))
    some = bit_filter(stored(one.select(F.xxhash64("one.doc", "one.tag").alias("key"))), "key")
    held = docs.sparkSession.sparkContext.broadcast(rarity)

    def emit(batch) -> pd.DataFrame:
        return pd.DataFrame({"class": [c for _, c in batch], "n": [len(t) for t, _ in batch], "tokens": [prefix(t, held.value, 0, percent).view(np.int64) for t, _ in batch]})

    out = stored(_sets(_chosen(docs, some, "doc", "tag"), width, emit, "class binary, n int, tokens array<long>"))
    some.destroy()
    held.destroy()
    return out


def live_rows(docs: DataFrame, rarity: np.ndarray, width: int, percent: int, rows: DataFrame | None = None) -> DataFrame:
    """(token, class, n, i): prefix tokens, and their places, under the first order that two classes share at least.

    ``rows``: those of ``measured``, if they are at hand.
    """
    rows = measured(docs, width)[0] if rows is None else rows
    before = stored_paths()
    found = prefixes(docs, rows, rarity, width, percent)
    # a class that came twice only lets through tokens that meet no other class
    shared = stored(found.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("token"))
    made = stored_paths() - before
    some = bit_filter(shared, "token")

    def places(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            tokens = batch.column("tokens")
            flat, ends = tokens.flatten().to_numpy(), np.cumsum(tokens.value_lengths().to_numpy())
            at = np.flatnonzero(in_filter(some.value, flat))
            of = np.searchsorted(ends, at, side="right")
            i = at - np.concatenate([[0], ends])[of]
            yield pa.RecordBatch.from_arrays([pa.array(flat[at]), batch.column("class").take(pa.array(of)), batch.column("n").take(pa.array(of)), pa.array(i.astype(np.int32))], names=["token", "class", "n", "i"])

    live = found.mapInArrow(places, "token long, class binary, n int, i int").distinct()
    out = stored(live.join(shared, "token"))
    some.destroy()
    drop_stored(docs.sparkSession, made)
    return out


def _to_leaders(live: DataFrame, percent: int) -> DataFrame:
    """Pairs of each class with the leaders of its tokens.

    A token's leader is the class in which it stands first: the one with the
    fewest rare tokens of its own, hence the middle of a group of near copies.
    One pair for a row at most, however many classes share a token.
    """
    lead = F.min(F.struct("i", "class", "n")).alias("lead")
    met = live.join(live.groupBy("token").agg(lead).hint("merge"), "token")
    met = met.filter("class <> lead.class and " + _may_link("n", "i", "lead.n", "lead.i", percent))
    return met.select(F.least("class", "lead.class").alias("a"), F.greatest("class", "lead.class").alias("b")).distinct()


def _across(live: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Every pair of classes of different labels that may link by their places of a common token.

    A pair is made at its first common token and not again while the tokens
    before are the same: those of one passage make one row.
    """
    rows = _labelled(live, labels)
    ends = rows.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("token")
    last = F.lag("token").over(Window.partitionBy("class").orderBy("i")).alias("before")
    rows = stored(rows.join(ends, "token").select("token", "class", "n", "i", "label", last))
    left, right = (rows.toDF("token", *[f"{c}_{side}" for c in rows.columns[1:]]) for side in "ab")
    met = left.join(right, "token").filter("class_a < class_b and label_a <> label_b and not (before_a <=> before_b and before_a is not null) and " + _may_link("n_a", "i_a", "n_b", "i_b", percent))
    return met.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct()


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))


def _spread(tokens: np.ndarray, bits: int) -> np.ndarray:
    """How many tokens fall on each of so many places, modulo 2, as packed bits."""
    return np.packbits(np.bincount((_mixed(tokens, 5) & _U(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little")


def _places(n: int) -> int:
    return max(64, 1 << (n - 1).bit_length())


def signature(tokens: np.ndarray, rarity: np.ndarray, percent: int) -> bytes:
    """What stands for a set of n in the filters: n, its prefixes under the second and later orders in 32 bits a token, parities of n places or more."""
    firsts = [(prefix(tokens, rarity, o, percent) >> _U(32)).astype(np.uint32) for o in range(1, ORDERS)]
    return b"".join([len(tokens).to_bytes(8, "little"), *[x.tobytes() for x in firsts], _spread(tokens, _places(len(tokens))).tobytes()])


def may_be_similar(x: bytes, y: bytes, percent: int) -> bool:
    """Whether two signatures meet under every order and differ in few enough places.

    Tokens that only one set has change the parity of their places, so sets
    differ in as many tokens as places at least; folding keeps that true.
    """
    n, m = (int.from_bytes(s[:8], "little") for s in (x, y))
    least = -(-percent * (n + m) // (100 + percent))
    if least > min(n, m):
        return False
    parts = []
    for s, k in ((x, n), (y, m)):
        size = 4 * (k - -(-percent * k // 100) + 1)
        parts.append([np.frombuffer(s, np.uint32, size // 4, 8 + size * o) for o in range(ORDERS - 1)] + [np.frombuffer(s, np.uint8, offset=8 + size * (ORDERS - 1))])
    if not all(_meet(p, q) for p, q in zip(parts[0][:-1], parts[1][:-1], strict=True)):
        return False
    width = min(len(p[-1]) for p in parts)
    one, two = (np.bitwise_xor.reduce(p[-1].reshape(-1, width)) for p in parts)
    return int(np.bitwise_count(one ^ two).sum()) <= n + m - 2 * least


def _of_classes(docs: DataFrame, rows: DataFrame, pairs: DataFrame, width: int, payload) -> DataFrame:
    """(class, payload) of the classes in the pairs, ``payload(tokens)`` being taken from one document of each."""
    classes = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    one = rows.join(classes.hint("merge"), "class").groupBy("class").agg(F.min("doc").alias("doc"))
    some = bit_filter(stored(one.select(F.xxhash64("doc").alias("key"))), "key")

    def emit(batch) -> pd.DataFrame:
        return pd.DataFrame({"class": [c for _, c in batch], "payload": [payload(t) for t, _ in batch]})

    out = stored(_sets(_chosen(docs, some, "doc"), width, emit, "class binary, payload binary").dropDuplicates(["class"]))
    some.destroy()
    return out


def _beside(pairs: DataFrame, of_class: DataFrame) -> DataFrame:
    """(a, b, x, y): the pairs with the payloads of both classes.

    A class of very many pairs is a skewed key of the pairs' side only, which
    adaptive execution splits: each class has one row on the other side.
    """
    return pairs.join(of_class.toDF("a", "x").hint("merge"), "a").join(of_class.toDF("b", "y").hint("merge"), "b").select("a", "b", "x", "y")


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.uint64)


def _meet(a: np.ndarray, b: np.ndarray) -> int:
    both = np.sort(np.concatenate([a, b]))
    return int((both[1:] == both[:-1]).sum())


def _kept(pairs: DataFrame, good) -> DataFrame:
    """The pairs (a, b) of which ``good(x, y)`` holds."""

    def test(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pdf.loc[np.fromiter(map(good, pdf["x"], pdf["y"]), bool, len(pdf)), ["a", "b"]]

    return stored(pairs.mapInPandas(test, "a binary, b binary"))


def linked(docs: DataFrame, rows: DataFrame, pairs: DataFrame, rarity: np.ndarray, width: int, percent: int) -> DataFrame:
    """The candidate pairs (a, b) that are similar enough.

    Candidates have met under the first order; those whose prefixes under
    every other order meet, too, and whose parities do not differ too much are
    left before whole sets are looked at.
    """

    def similar(x: bytes, y: bytes) -> bool:
        a, b = _numbers(x), _numbers(y)
        common = _meet(a, b)
        return 100 * common >= percent * (len(a) + len(b) - common)

    held = docs.sparkSession.sparkContext.broadcast(rarity)
    signatures = _of_classes(docs, rows, pairs, width, lambda t: signature(t, held.value, percent))
    left = _kept(_beside(pairs, signatures), lambda x, y: may_be_similar(x, y, percent))
    held.destroy()
    if left.isEmpty():
        return left
    return _kept(_beside(left, _of_classes(docs, rows, left, width, np.ndarray.tobytes)), similar)


def links(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): every text's class and size, and (node, label) of the linked classes.

    Links enough for exact components are found: first those with the leaders
    of tokens, which join a large group of near copies in about as many pairs
    as it has rows; then every pair across components that passes the filters.
    Links inside a component that has formed already are neither verified nor
    counted: a group of k near copies can have k * k of them.
    """
    rows, counts = measured(docs, width)
    rarity = _rarity(counts)
    live = live_rows(docs, rarity, width, percent, rows)
    led = stored(_to_leaders(live, percent))
    found = linked(docs, rows, led, rarity, width, percent)
    labels = stored(connected_components(found))
    rest = stored(_across(live, labels, percent).join(led, ["a", "b"], "left_anti"))
    late = linked(docs, rows, rest, rarity, width, percent)
    if late.isEmpty():
        return rows, labels
    return rows, stored(connected_components(found.union(late)))


def _keyed(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    require(docs, id_col, text_col)
    if not 0 < percent <= 100:
        raise ValueError("percent must be 1 to 100")
    return docs.select(F.col(id_col).cast("long").alias("doc"), row_tag(F.col(text_col)).alias("tag"), F.col(text_col).alias("text"))


def _representatives(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(class, label, first): the row of the smallest id, then hash, of each class with words; null ids come last."""
    first = F.min(F.struct(F.col("doc").isNull().alias("unknown"), "doc", "tag")).alias("first")
    return _labelled(rows.filter("n > 0").groupBy("class").agg(first), labels)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per input row: the id, ``n_shingles`` and ``component_id``.

    A text's set: its distinct shingles of ``width`` words (A-Z lower-cased,
    words are runs without ASCII white space); with fewer words, all of them as
    one shingle.  Texts link when ``100 * common >= percent * union``;
    ``component_id`` is the smallest id reachable by links.  Texts without
    words (null, empty, blank) have no set and link with nothing.  Equal sets
    are one class, so copies add no pairs.  Ids are integers; null ids are
    never the smallest beside others, and a component of null ids only has a
    null ``component_id``.  Rows that repeat an id are judged by their own
    texts.  Components are exact; links inside them are not counted.
    Shingles are compared by 64-bit hashes, sets named by 128-bit ones.
    """
    rows, labels = links(_keyed(docs, id_col, text_col, percent), width, percent)
    placed = _representatives(rows, labels)
    by_label = placed.groupBy("label").agg(F.min("first").alias("first"))
    of_class = placed.select("class", "label").join(by_label, "label").select("class", F.col("first.doc").alias("component_id"))
    out = rows.join(of_class.hint("merge"), "class", "left")
    component = F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("component_id"))
    return out.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, less all but one of each component of ``near_duplicates``.

    The row of the smallest id stays (null ids come last), then of the
    smallest hash of its text; rows are judged by id and text, so other texts
    of one id stay.  Of rows equal in both, one stays, whichever.  Rows
    without words all stay.
    """
    rows, labels = links(_keyed(docs, id_col, text_col, percent), width, percent)
    first = _representatives(rows, labels).groupBy("label").agg(F.min("first").alias("first")).select("first.doc", "first.tag")
    copies = rows.filter("n > 0").groupBy("doc", "tag").agg(F.count(F.lit(1)).alias("n"))
    same = copies["doc"].eqNullSafe(first["doc"]) & (copies["tag"] == first["tag"])
    chosen = stored(copies.join(first, same, "left_semi").toDF("_kept_doc", "_kept_tag", "_kept_n"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    blank = ~text.rlike(r"[^\x20\x09-\x0D]")
    met = docs.filter(~blank).join(chosen, F.col(id_col).cast("long").eqNullSafe(F.col("_kept_doc")) & (row_tag(F.col(text_col)) == F.col("_kept_tag")))
    out = met.filter("_kept_n = 1").select(*docs.columns).union(docs.filter(blank))
    if chosen.filter("_kept_n > 1").isEmpty():
        return out
    return out.union(met.filter("_kept_n > 1").dropDuplicates(["_kept_doc", "_kept_tag"]).select(*docs.columns))
