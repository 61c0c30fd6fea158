from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid.llm import packing


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts, strict=True))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 50), min_size=1, max_size=8), st.integers(1, 5))
def test_boundaries_are_optimal(hist, k):
    lengths = sorted(hist)
    counts = [hist[n] for n in lengths]
    bounds = packing.optimal_boundaries(lengths, counts, k)
    assert len(bounds) <= k and bounds[-1] == lengths[-1] and bounds == sorted(set(bounds))
    best = min(padding(lengths, counts, [*c, lengths[-1]]) for n in range(k) for c in combinations(lengths[:-1], n))
    assert padding(lengths, counts, bounds) == best


def test_pieces_cover_whole_texts(spark):
    rows = [(1, "a b c d e f g"), (2, None), (3, " \n"), (4, "x"), (4, "x")]
    got = packing.pieces(spark.createDataFrame(rows, "doc_id long, text string"), max_len=3).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.n_tokens) for r in got) == [(1, 0, 0, 3), (1, 1, 3, 3), (1, 2, 6, 1), (4, 0, 0, 1), (4, 0, 0, 1)]


def test_batches_are_full_and_lose_nothing(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), 0, int(n), "clash") for i, n in enumerate(rng.integers(1, 60, 5000))]
    df = spark.createDataFrame(rows, "doc_id long, piece int, n_tokens int, batch string").withColumns({"_salt": F.lit(7), "_slice": F.lit(8), "_bucket": F.lit(9), "bucket": F.lit("old"), "n.dotted": F.lit(1)})
    packed = packing.pack(df, n_buckets=4, budget=256, max_len=64, slice_rows=100)
    assert packed.count() == 5000 and packed.columns == ["doc_id", "piece", "n_tokens", "_salt", "_slice", "_bucket", "n.dotted", "bucket", "batch"]
    assert packed.select("_salt", "_slice", "_bucket").distinct().collect() == [(7, 8, 9)]
    assert packed.filter("bucket < n_tokens").count() == 0
    full = {}
    for b in packing.batches(packed).collect():
        assert b.n_pieces <= 256 // b.bucket and b.n_tokens + b.n_padding == b.n_pieces * b.bucket
        full.setdefault(b.bucket, []).append(b.n_pieces)
    assert len(full) == 4
    for bucket, sizes in full.items():
        assert sum(s < 256 // bucket for s in sizes) <= 1


def test_edges(spark):
    schema = "doc_id long, piece int, n_tokens int"
    assert packing.pack(spark.createDataFrame([], schema)).count() == 0
    assert packing.pack(spark.createDataFrame([(1, 0, None), (None, 0, 0), (None, 0, 4)], schema)).count() == 1
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([], schema), budget=10)
    with pytest.raises(Exception, match="longer than max_len"):
        packing.pack(spark.createDataFrame([(1, 0, 5000)], schema))


def test_query_matches_brute_force(spark):
    """The pieces, their buckets, and full batches in the stated order, from the texts themselves."""
    import re

    from pulsegrid.llm import queries

    sf = "/root/testdata/sf0.001"
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        want += [(r.doc_id, k, start, min(2048, n - start)) for k, start in enumerate(range(0, n, 2048))]
    got = queries.op9_packing(spark, sf).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.n_tokens) for r in got) == sorted(want)
    lengths = sorted({w[3] for w in want})
    counts = [sum(w[3] == n for w in want) for n in lengths]
    bounds = sorted({r.bucket for r in got})
    assert len(bounds) <= 16 and all(r.bucket == min(b for b in bounds if b >= r.n_tokens) for r in got)
    # least padding: best[k][j] over the lengths up to the j-th with k buckets
    best = [[0] + [10**12] * len(lengths)]
    for _ in range(16):
        best.append([0] + [min(best[-1][i] + sum(c * (lengths[j - 1] - n) for n, c in zip(lengths[i:j], counts[i:j], strict=True)) for i in range(j)) for j in range(1, len(lengths) + 1)])
    assert sum(r.bucket - r.n_tokens for r in got) == min(b[-1] for b in best)
    sizes = {}
    for r in got:
        sizes.setdefault(r.bucket, {}).setdefault(r.batch, []).append(r)
    for b, groups in sizes.items():
        full = sorted((int(k.split("-")[1]), len(v)) for k, v in groups.items())
        assert [k for k, _ in full] == list(range(len(full))) and all(n == 16_384 // b for _, n in full[:-1])
