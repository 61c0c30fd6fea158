from collections import Counter

import numpy as np
import pandas as pd
import pytest

from pulsegrid.llm import substring_dedup


def brute(rows, t):
    raws = [(x or "").encode() for _, x in rows]
    seen = Counter(r[i : i + t] for r in raws for i in range(len(r) - t + 1))
    out = []
    for (k, _), r in zip(rows, raws, strict=True):
        gone = np.zeros(len(r), dtype=bool)
        for i in range(len(r) - t + 1):
            if seen[r[i : i + t]] > 1:
                gone[i : i + t] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out.append((k, len(r), list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)), bytes(b for b, g in zip(r, gone, strict=True) if not g)))
    return out


def corpus():
    rng = np.random.default_rng(3)
    text = lambda n: "".join(rng.choice(list("abcdeé \n"), n))
    p, q = text(90), text(30)
    rows = [(1, p), (2, text(40) + p[10:60] + text(20)), (3, text(5) + q + text(70) + q), (4, None), (5, ""), (6, "a" * 300), (7, "ab" * 100), (8, p), (8, p), (9, text(20) + p[:33] + text(3) + p[33:70]), (None, q + text(9))]
    rows += [(20 + i, text(8) + q[2:] + text(8)) for i in range(25)] + [(60 + i, q[: 20 + i % 8] + text(30)) for i in range(12)]
    return rows


@pytest.mark.parametrize("threshold,most", [(16, 20_000), (16, 2), (25, 20_000), (40, 5)])
def test_matches_brute_force(spark, threshold, most):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, spans int")
    got = substring_dedup.dedup_substrings(df, threshold=threshold, most_contexts=most).collect()
    found = sorted(((r.doc_id is None, r.doc_id or 0, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in got))
    assert found == sorted((i is None, i or 0, n, s, k) for i, n, s, k in brute(rows, threshold))


def test_texts_longer_than_a_chunk(spark, monkeypatch):
    rng = np.random.default_rng(5)
    long = "".join(rng.choice(list("abcdefgh"), 5000))
    rows = [(1, long), (2, "x" * 10 + long[1000:1400] + "y"), (3, long[4990:] + long[:400])]
    want = brute(rows, 50)
    monkeypatch.setattr(substring_dedup, "CHUNK", 700)
    parts = list(substring_dedup.Anchors(50).find([long.encode()]))
    places = sorted(p for part in parts for p in part[1].tolist())
    monkeypatch.undo()
    everything = sorted(p for part in substring_dedup.Anchors(50).find([long.encode()]) for p in part[1].tolist())
    assert places == everything and len(places) > 50
    got = substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), threshold=50).collect()
    assert sorted((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in got) == want


def test_no_rows_and_bad_threshold(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.dedup_substrings(none).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.dedup_substrings(none, threshold=3)


def test_query_matches_brute_force(spark):
    import hashlib

    from pulsegrid.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.op6_substring_dedup(spark, sf).collect()}
    for i, n, spans, kept in brute(docs, 200):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest())


def _twins():
    """Two different texts of 200 letters whose polynomial hashes modulo 2**64 agree for every odd base."""
    a, b = "goor", "K1A9"
    one = other = ""
    for k in range(16):
        odd = bin(k).count("1") % 2
        one, other = one + (b if odd else a), other + (a if odd else b)
    start = ("start of both texts, " * 7)[:136]
    return start + one, start + other


def test_unequal_texts_of_equal_polynomial_hash_stay(spark):
    one, other = _twins()
    assert len(one) == len(other) == 200 and one != other
    for texts in ([one, other], [one + "x" * 9, other + "yy"], [one, other, one]):
        rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        for most in (20_000, 1):
            got = {r.doc_id: bytes(r.kept).decode() for r in substring_dedup.dedup_substrings(rows, most_contexts=most).collect()}
            assert got == {k: "" if texts.count(t) > 1 else t for k, t in enumerate(texts)}


@pytest.mark.parametrize("doubted", [False, True])
def test_digits_by_hash_or_bytes_give_the_groups_of_equal_bytes(monkeypatch, doubted):
    if doubted:
        monkeypatch.setattr(substring_dedup._Matrix, "equal", lambda *_: False)
    one, other = _twins()
    base = "b" * 112
    contexts = [base + one + other, base + other + one, base + one + one, "c" * 112 + one + other]
    raws = [c.encode()[:312] for c in contexts]
    frame = pd.DataFrame({"anchor": 1, "doc": range(4), "tag": 0, "place": 112, "alone": True, "before": 112, "bytes": raws})
    got = substring_dedup._sorted_windows(frame, 200)
    expect = []
    for k, raw in enumerate(raws):
        hits = [d for d in range(113) if any(raw[112 - d : 312 - d] == other[112 - d : 312 - d] for i, other in enumerate(raws) if i != k)]
        if hits:
            expect.append((k, 112 - max(hits), 312 - min(hits)))
    assert sorted(zip(got["doc"].tolist(), got["start"].tolist(), got["end"].tolist())) == expect
