import re
from collections import Counter
from fractions import Fraction

import pytest

from pulsegrid.llm import collocations

SCHEMA = "doc_id long, lang string, text string, phrase string, n long"


def brute(rows, longest, least, most):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\n-\r]", folded):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for (lang, w), a in f.items():
        if len(w) < 2 or a < least:
            continue
        score, k = min((int(Fraction(1000 * a * n[lang], f[lang, w[:k]] * f[lang, w[k:]])), k) for k in range(1, len(w)))
        longer = [b for (other, v), b in f.items() if other == lang and len(v) > len(w) and b >= least and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if not any(b >= a for b in longer):
            out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]], n[lang]))
    ranked, rank = [], Counter()
    for lang, score, a, phrase, left, right, total in sorted(out):
        rank[lang] += 1
        if rank[lang] <= most:
            ranked.append((lang, rank[lang], phrase.decode(), -a, left, right, total, -score))
    return sorted(ranked)


def mined(spark, rows, **params):
    docs = spark.createDataFrame([(k, lang, text, "x", 1) for k, (lang, text) in enumerate(rows)], SCHEMA)
    return sorted(tuple(r) for r in collocations.mine_collocations(docs, **params).collect())


ROWS = [
    *[("en", "New York city hall, New York. the new york city")] * 3,
    *[("en", "ha ha ha ha ha ha; a\tb  a b a b\x0ba b")] * 2,
    *[(None, "Ähre ähre Straße. null Lang")] * 3,
    ("de", ""),
    ("de", None),
    ("de", "!?.,;:"),
    *[("fr", "un deux trois quatre cinq six sept")] * 4,
    *[("fr", "un deux trois, quatre deux trois")] * 4,
]


@pytest.mark.parametrize("least", [2, 3, 4])
def test_equals_brute_force(spark, least):
    assert mined(spark, ROWS, least=least) == brute(ROWS, 5, least, 2_000)


def test_slices_of_long_texts_lose_and_repeat_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 11)
    rows = [("en", "one two three four five six, seven " * 9), ("en", "averylongwordwithoutanyend one two three"), ("en", "one two\nthree four")]
    raws = [t.encode() for _, t in rows]
    whole = [sum(int((c[:own] >= 0).sum()) for c, _, own in collocations._words(raws, n)) for n in (2, 5)]
    assert whole == [sum(len(re.findall(r"[^ \t\n,]+", t)) for _, t in rows)] * 2
    windows = Counter()
    for codes, words, own in collocations._words(raws, 5):
        said = [None if c < 0 else words[c].decode() for c in codes.tolist()]
        for i, w in enumerate(said[:own]):
            windows[tuple(said[i : i + 5][: (said[i : i + 5] + [None]).index(None)])] += w is not None
    expect = Counter()
    for _, t in rows:
        for piece in re.split(r"[,\n]", t):
            w = piece.split()
            expect.update(tuple(w[i : i + 5]) for i in range(len(w)))
    assert +windows == expect


def test_ranks_ties_by_bytes_and_keeps_the_first(spark):
    rows = [("en", f"{a} {b}.") for a, b in (("é", "x"), ("z", "y"), ("Z2", "y2"))] * 2
    got = mined(spark, rows, least=2, most=2)
    assert [r[2] for r in got] == ["z y", "z2 y2"]
    assert got == brute(rows, 5, 2, 2)


def test_no_rows_and_missing_columns(spark):
    assert mined(spark, []) == []
    with pytest.raises(ValueError):
        collocations.mine_collocations(spark.createDataFrame([("a",)], "text string"))
