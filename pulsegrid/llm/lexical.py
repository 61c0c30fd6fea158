"""Exact ranked lexical search by hashed sketches of the greatest impacts."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import require, small_batches, stored

#: Terms of all queries of a block; what is broadcast has a few hundred bytes a term.
BLOCK_TERMS = 50_000
#: Bytes of text that a task takes apart at once, and queries that it bounds at once.
CHUNK, QUERIES = 1 << 21, 256
#: Rows of a sketch, and cells of a row for each distinct term, at least.
ROWS, CELLS = 3, 4
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(c if c >= 128 or c in _KEPT else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def terms_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, A-Z lower-cased; none in null."""
    return (text or "").encode().translate(_FOLD).split()


def _hashes(terms: np.ndarray) -> np.ndarray:
    h = pd.util.hash_array(terms, categorize=False) * _MIX
    return h ^ (h >> np.uint64(32))


def _cells(hashed: np.ndarray, row: int, width: int) -> np.ndarray:
    """Where terms lie in a row of a sketch; ``width`` is a power of 2."""
    return ((hashed >> np.uint64(20 * row)) & np.uint64(width - 1)).astype(np.int64)


def _objects(values: list) -> np.ndarray:
    out = np.empty(len(values), dtype=object)
    out[:] = values
    return out


class _Chunk:
    """Texts as (text, term) cells with counts, sorted by text."""

    def __init__(self, texts: list[str | None]) -> None:
        lists = [terms_of(x) for x in texts]
        self.n = np.array([len(x) for x in lists], dtype=np.int64)
        codes, self.terms = pd.factorize(_objects([w for x in lists for w in x]))
        row = np.repeat(np.arange(len(lists)), self.n)
        width = max(len(self.terms), 1)
        cell, self.tf = np.unique(row * width + codes, return_counts=True)
        self.row, self.term = cell // width, cell % width
        self.ends = np.searchsorted(self.row, np.arange(len(lists)), side="right")
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)


def _chunks(pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, _Chunk]]:
    """Rows of a batch, ``CHUNK`` bytes of text or one text at a time."""
    size = pdf["text"].map(lambda x: len(x) if x else 0).cumsum().to_numpy()
    at = 0
    while at < len(pdf):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + CHUNK, side="right")))
        some = pdf.iloc[at:end]
        yield some, _Chunk(some["text"].tolist())
        at = end


def collection_statistics(docs: DataFrame, terms: Broadcast) -> tuple[int, int, dict[bytes, int]]:
    """N, L and the document frequency of each of the broadcast terms, in one pass.

    Only the given terms' counts leave a task, so the driver gets a row a term.
    """

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = {t: k for k, t in enumerate(terms.value)}
        df = np.zeros(len(wanted) + 2, dtype=np.int64)
        for pdf in parts:
            for _, chunk in _chunks(pdf):
                of = np.array([wanted.get(t, -1) for t in chunk.terms.tolist()], dtype=np.int64)
                df[:-2] += np.bincount(of[chunk.term][of[chunk.term] >= 0], minlength=len(wanted)) if len(of) else 0
                df[-2:] += np.count_nonzero(chunk.n), chunk.n.sum()
        at = np.flatnonzero(df)
        yield pd.DataFrame({"term": at, "n": df[at]})

    with small_batches(docs.sparkSession):
        rows = docs.select("text").mapInPandas(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found, every = {r.term: r.n for r in rows}, terms.value
    return found.get(len(every), 0), found.get(len(every) + 1, 0), {t: found.get(k, 0) for k, t in enumerate(every)}


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: int, n_docs: int, n_terms: int) -> int:
    return 10 + (90 * n * n_docs) // n_terms


class _Scorer:
    """Bounds and exact scores of a block of queries over chunks of texts."""

    def __init__(self, queries: list[tuple[int, list[bytes]]], df: dict[bytes, int], n_docs: int, n_terms: int, k: int) -> None:
        self.n_docs, self.n_terms, self.k = n_docs, n_terms, k
        every = sorted({t for _, q in queries for t in q})
        place = {t: i for i, t in enumerate(every)}
        self.place, self.hash = place, _hashes(_objects(every))
        self.weights = np.array([term_weight(n_docs, df[t]) for t in every], dtype=np.int64)
        self.queries = [np.array([place[t] for t in q], dtype=np.int64) for _, q in queries]
        self.heaps: list[list[tuple[int, int, int]]] = [[] for _ in queries]
        self.least = np.zeros(len(queries))

    def _impacts(self, chunk: _Chunk) -> np.ndarray:
        m = np.array([length_factor(int(n), self.n_docs, self.n_terms) if n else 1 for n in chunk.n.tolist()], dtype=np.int64)
        return (1_000_000_000 * chunk.tf) // (1000 * chunk.tf + 8 * m[chunk.row])

    def _sketches(self, chunk: _Chunk, impact: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(texts, sketches of ``ROWS`` rows): the greatest impact in each cell, texts of one width at a time."""
        hashed = _hashes(chunk.terms)
        distinct = chunk.ends - chunk.starts
        width = 1 << np.ceil(np.log2(np.maximum(CELLS * distinct, 64))).astype(np.int64)
        rising = np.argsort(impact, kind="stable")
        for w in np.unique(width[distinct > 0]).tolist():
            rows = np.flatnonzero((width == w) & (distinct > 0))
            at = np.full(len(width), -1)
            for some in np.array_split(rows, -(-len(rows) * w * ROWS // (1 << 21))):
                at[:] = -1
                at[some] = np.arange(len(some))
                cells = rising[at[chunk.row[rising]] >= 0]
                sketch = np.zeros((ROWS, len(some), w))
                for r in range(ROWS):  # of several terms in a cell the last one, of the greatest impact, stays
                    sketch[r][at[chunk.row[cells]], _cells(hashed[chunk.term[cells]], r, w)] = impact[cells]
                yield some, sketch

    def _bounds(self, sketch: np.ndarray) -> np.ndarray:
        """No less than the impact of each query term in each text: the least of its cells in the rows."""
        return reduce(np.minimum, [sketch[r][:, _cells(self.hash, r, sketch.shape[2])] for r in range(ROWS)])

    def add(self, docs: list, chunk: _Chunk) -> None:
        """Take a chunk: bound every text under every query, rescore the best bounds first."""
        impact = self._impacts(chunk)
        of = np.array([self.place.get(t, -1) for t in chunk.terms.tolist()], dtype=np.int64)
        exact: dict[int, np.ndarray] = {}
        for texts, sketch in self._sketches(chunk, impact):
            seen = self._bounds(sketch)
            for first in range(0, len(self.queries), QUERIES):
                block = self.queries[first : first + QUERIES]
                used = np.unique(np.concatenate(block))
                of_used = np.zeros((len(used), len(block)))
                for j, q in enumerate(block):
                    of_used[np.searchsorted(used, q), j] = self.weights[q]
                bound = (seen[:, used] @ of_used) * (1 + 1e-9)  # beyond what sums of doubles may lose
                row, col = np.nonzero((bound >= self.least[first : first + len(block)]) & (bound > 0))
                best = np.argsort(-bound[row, col], kind="stable")
                for i, j, b in zip(texts[row[best]].tolist(), (col[best] + first).tolist(), bound[row[best], col[best]].tolist(), strict=True):
                    if b < self.least[j]:
                        continue
                    if i not in exact:
                        cells = slice(chunk.starts[i], chunk.ends[i])
                        terms = of[chunk.term[cells]]
                        exact[i] = np.zeros(len(self.weights), dtype=np.int64)
                        exact[i][terms[terms >= 0]] = impact[cells][terms >= 0]
                    self._offer(j, int((self.weights[self.queries[j]] * exact[i][self.queries[j]]).sum()), docs[i])

    def _offer(self, j: int, score: int, doc: int | None) -> None:
        if score <= 0:
            return
        heap = self.heaps[j]
        entry = (score, doc is not None, -doc if doc is not None else 0)  # null ids last among equals
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)
        if len(heap) == self.k:
            self.least[j] = heap[0][0]

    def found(self) -> pd.DataFrame:
        rows = [(j, -d if known else None, s) for j, heap in enumerate(self.heaps) for s, known, d in heap]
        return pd.DataFrame(rows, columns=["query", "doc_id", "score"]).astype({"query": "int64", "doc_id": "Int64", "score": "int64"})


def _blocks(queries: DataFrame, most_terms: int) -> Iterator[list[tuple[object, list[bytes]]]]:
    """(id, distinct terms) of queries, rows of one id together, ``most_terms`` terms or one query at a time."""
    held: list[tuple[object, list[bytes]]] = []
    size = 0
    terms: set[bytes] = set()
    last: object = None
    some = False
    for r in queries.orderBy("id").toLocalIterator():
        if some and r.id != last:
            if held and size + len(terms) > most_terms:
                yield held
                held, size = [], 0
            held.append((last, sorted(terms)))
            size += len(terms)
            terms = set()
        last, some = r.id, True
        terms |= set(terms_of(r.text))
    if some:
        held.append((last, sorted(terms)))
    if held:
        yield held


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", query_col: str = "item_id", text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(query id, rank, id, score): the ``k`` best documents of every query with a score above 0.

    A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))), its impact in a text of n terms
    (10^9 tf) div (1000 tf + 8 m) with m = 10 + (90 n N) div L; a score sums weight times impact over the
    distinct terms of the query.  Every text's impacts fold into a sketch, ``ROWS`` rows of the greatest impact
    a hashed cell, at least ``CELLS`` cells a distinct term; cells looked up for all queries of a block
    (the least of the rows) bound all scores, and texts are scored exactly from the highest bound down until no bound reaches the k-th best
    score of the task.  Tasks give k texts a query; the best of them are ranked, equal scores by id.

    Queries come in blocks of ``block_terms`` terms, each with two passes over the texts.  Null texts have
    no terms and are never found; queries without terms find nothing; queries of one id count as one;
    repeated rows of an id rank one after the other; a null id comes last among equal scores; empty tables
    give no rows.  Ids are integers; other columns are not read.
    """
    require(docs, id_col, text_col)
    require(queries, query_col, text_col)
    spark = docs.sparkSession
    doc = F.col(id_col).cast("long")
    texts = docs.select(F.coalesce(doc, F.lit(0)).alias("doc_id"), doc.isNotNull().alias("known"), F.col(text_col).alias("text"))
    query_type = queries.schema[query_col].dataType.simpleString()
    asked = queries.select(F.col(query_col).alias("id"), F.col(text_col).alias("text"))
    parts: list[DataFrame] = []
    for block in _blocks(asked, block_terms):
        real = [q for q in block if q[1]]
        if not real:
            continue
        terms = spark.sparkContext.broadcast(sorted({t for _, q in real for t in q}))
        n_docs, n_terms, df = collection_statistics(texts, terms)
        terms.destroy()
        if not n_terms:
            break
        shipped = spark.sparkContext.broadcast(([(j, q) for j, (_, q) in enumerate(real)], df, n_docs, n_terms, k))

        def run(batches: Iterator[pd.DataFrame], shipped: Broadcast = shipped) -> Iterator[pd.DataFrame]:
            scorer = None
            for pdf in batches:
                scorer = scorer or _Scorer(*shipped.value)
                for some, chunk in _chunks(pdf):
                    scorer.add([d if known else None for d, known in zip(some["doc_id"].tolist(), some["known"].tolist(), strict=True)], chunk)
            if scorer:
                yield scorer.found()

        names = spark.createDataFrame([(j, i) for j, (i, _) in enumerate(real)], f"query long, id {query_type}")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = texts.mapInPandas(run, "query long, doc_id long, score long").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        parts.append(stored(best.join(F.broadcast(names), "query").select(F.col("id").alias(query_col), "rank", F.col("doc_id").alias(id_col), "score")))
        shipped.destroy()
    if not parts:
        return spark.createDataFrame([], f"`{query_col}` {query_type}, rank int, `{id_col}` long, score long")
    return reduce(DataFrame.unionByName, parts)
