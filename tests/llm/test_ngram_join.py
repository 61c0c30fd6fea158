import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import ngram_join
from pulsegrid.llm.components import connected_components


def brute(rows, width=5, percent=80):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted((k is None, k or 0, len(s), least.get(find(i)) or 0) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True)))


def run(spark, rows, **more):
    got = ngram_join.near_duplicates(spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_shingles int"), **more)
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got.collect())


def changed(rng, words, n):
    out = list(words)
    for p in rng.choice(len(out), n, replace=False):
        out[p] = f"z{rng.integers(10**6)}"
    return " ".join(out)


def test_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 400, n)]
    rows, shared = [], word(60)
    for g in range(12):
        base = word(int(rng.integers(20, 150)))
        rows += [(1000 - 40 * g - k, changed(rng, base, int(k % 4))) for k in range(8)]
    # one large group that drifts, so its ends link only through others
    drift = word(120)
    for k in range(60):
        drift[int(rng.integers(120))] = f"d{k}"
        rows.append((3000 - k, " ".join(drift)))
    # a common passage in texts that are otherwise different
    rows += [(5000 + k, " ".join(shared + word(int(rng.integers(5, 40))))) for k in range(40)]
    rows += [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE\x0btwo"), (8, "é É"), (9, "É é"), (9, "É é"), (None, "one two"), (10, "tall " * 30_000), (11, "tall " * 7)]
    assert run(spark, rows) == brute(rows)


def test_threshold_is_inclusive(spark):
    a = [f"a{i}" for i in range(13)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:-1])), (3, " ".join(a[:11])), (4, " ".join(f"b{i}" for i in range(8))), (5, " ".join(f"b{i}" for i in range(9)))]
    assert run(spark, rows) == brute(rows)


def test_no_rows_one_row_and_bad_percent(spark):
    assert run(spark, []) == []
    assert run(spark, [(7, "a b c d e f")]) == [(False, 7, 2, 7)]
    with pytest.raises(ValueError):
        run(spark, [], percent=0)


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(0)
    rarity = rng.integers(0, 40, 1 << ngram_join.SKETCH_BITS).astype(np.uint8)
    for _ in range(300):
        n = int(rng.integers(1, 80))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.95], rng.integers(0, 1 << 63, int(rng.integers(0, 4)), dtype=np.uint64)]))
        if 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)):
            for order in range(ngram_join.ORDERS):
                assert len(np.intersect1d(ngram_join.prefix(a, rarity, order, 80), ngram_join.prefix(b, rarity, order, 80)))
            assert ngram_join.may_be_similar(ngram_join.signature(a, rarity, 80), ngram_join.signature(b, rarity, 80), 80)


def test_signatures_of_unlike_sets_part():
    rng = np.random.default_rng(1)
    rarity = np.zeros(1 << ngram_join.SKETCH_BITS, dtype=np.uint8)
    for n in (40, 500, 9000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: n * 3 // 5], rng.integers(0, 1 << 63, n * 2 // 5, dtype=np.uint64)]))
        assert not ngram_join.may_be_similar(ngram_join.signature(a, rarity, 80), ngram_join.signature(b, rarity, 80), 80)


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 150), (300, 300), (101, 100)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {100: 100, 200: 100, 150: 100, 101: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_that_a_polynomial_hash_confuses_stay_apart(spark):
    """A Thue-Morse word of two letters and its complement are equal modulo 2**64 in any odd base."""
    bits = [bin(k).count("1") % 2 for k in range(2048)]
    rows = [(1, "".join("ab"[b] for b in bits)), (2, "".join("ba"[b] for b in bits)), (3, "ab"), (4, "ba")]
    assert run(spark, rows) == brute(rows)


def test_a_large_group_of_near_copies_with_outliers(spark):
    """Copies of one text with few to many changed words: most link to it, others to some copies only."""
    rng = np.random.default_rng(8)
    base = [f"w{x}" for x in rng.integers(0, 400, 150)]
    rows = [(10_000, " ".join(base))]
    for k in range(250):
        rows.append((k, changed(rng, base, int(rng.integers(1, 7)))))
    for k in range(60):
        rows.append((5000 + k, changed(rng, rows[1 + int(rng.integers(250))][1].split(), int(rng.integers(1, 4)))))
    assert run(spark, rows) == brute(rows)
    docs = spark.createDataFrame([(i, b"", t) for i, t in rows], "doc long, tag binary, text string")
    found, counts = ngram_join.measured(docs, 5)
    rarity = ngram_join._rarity(counts)
    live = ngram_join.live_rows(docs, rarity, 5, 80)
    led = ngram_join._to_leaders(live, 80)
    assert led.count() < 3 * len(rows)
    labels = connected_components(ngram_join.linked(docs, found, led, rarity, 5, 80))
    assert ngram_join._across(live, labels, 80).count() < 3 * len(rows)


def test_keep_one_row_of_each_group(spark):
    a, b, c = "a b c d e f g", "h i j k l m n", "o p q r s t u"
    rows = [(3, b, 0), (5, a, 1), (5, b, 2), (7, c, 3), (7, c, 4), (None, b, 5), (None, "x y", 6), (None, "x y", 7), (8, "X  y", 8), (9, None, 9), (9, "", 10), (9, "", 11), (4, "\x0b ", 12), (None, "only null", 13)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tag int").withColumns({"doc": F.lit(1), "class": F.lit(2), "n": F.lit(3)})
    got = ngram_join.keep_one(df)
    assert got.columns == df.columns
    kept = {r.tag for r in got.collect()}
    assert kept - {3, 4} == {0, 1, 8, 9, 10, 11, 12, 13} and len(kept & {3, 4}) == 1
    assert ngram_join.keep_one(df.limit(0)).count() == 0


def test_texts_are_taken_apart_once_for_prefixes(spark, monkeypatch):
    scans, sets = [], ngram_join._sets
    monkeypatch.setattr(ngram_join, "_sets", lambda docs, width, emit, schema: scans.append(schema) or sets(docs, width, emit, schema))
    rows = [(1, "a b c d e f g h i j k l m n o"), (2, "a b c d e f g h i j k l m n p"), (3, "a b c d e f g h i j k l m n o"), (4, "other words")]
    assert run(spark, rows) == brute(rows)
    assert sum("token" in s for s in scans) == 1


def test_word_hashes_tell_words_apart():
    rng = np.random.default_rng(3)
    texts = [b"", b" ", b"\x0b\x1c", b"a", b" a\x00  a\x00\x00\ta", "é \x85 x".encode()]
    texts += [bytes(rng.choice(list(b"ab\x00\xc3 \n"), int(rng.integers(1, 400)), p=[0.4, 0.4, 0.05, 0.05, 0.05, 0.05]).tolist()) for _ in range(300)]
    seen = {}
    for t in texts:
        words, hashes = t.split(), ngram_join.word_hashes(t).tolist()
        assert len(words) == len(hashes)
        assert all(seen.setdefault(w, h) == h for w, h in zip(words, hashes, strict=True))
    assert len(seen) == len(set(seen.values())) > 1000
