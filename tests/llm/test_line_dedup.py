import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def brute(rows, min_words=8, max_edits=1):
    lines = [(i, n, line.split()) for i, t in rows for n, line in enumerate((t or "").split("\n"))]
    out = {}
    for i, t in rows:
        kept = []
        for n, line in enumerate((t or "").split("\n")):
            w = line.split()
            gone = w and any((j, m) < (i, n) and (v == w or (max_edits and max(len(v), len(w)) >= min_words and distance(v, w) <= 1)) for j, m, v in lines if v)
            if not gone:
                kept.append(line)
        out[i] = None if t is None else "\n".join(kept)
    return out


L = "a b c d e f g h i j".split()
ROWS = [
    (1, " ".join(L) + "\n\n  \nshort line\nlast"),
    (2, " ".join(L[:4] + ["X"] + L[5:]) + "\nshort line\nshort lines"),
    (3, " ".join(L[1:]) + "\n" + " ".join(L + ["k"]) + "\n" + " ".join(L[:2] + L[4:])),
    (4, None),
    (5, ""),
    (6, "a  b c d e f g\ta b\r\nlast \nnew"),
    (7, "p q r s t u v w\np q r s t u v\np q r s t u\n" + "p q r s t u v Z"),
    (8, "word " * 30_000 + "\nend"),
    (9, "word " * 30_001 + "\nend"),
    (10, "t0 one two three four five six seven\nt1 one two three four five six seven\nt2 one two three four five six seven"),
]


@pytest.mark.parametrize("max_edits", [0, 1])
def test_matches_brute_force(spark, max_edits):
    df = spark.createDataFrame([(i, t, 9) for i, t in ROWS], "doc_id long, text string, n_lines int")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(df, max_edits=max_edits).collect()}
    small = [r for r in ROWS if r[0] not in (8, 9)]
    want = brute(small, max_edits=max_edits)
    assert {i: got[i].text for i in want} == want
    assert got[8].text == ROWS[7][1] and got[9].text == ("" if max_edits else "word " * 30_001)
    assert (got[4].n_lines, got[5].n_lines, got[1].n_lines, got[1].n_removed) == (0, 0, 3, 0)


def test_a_later_copy_of_the_earliest_line(spark):
    """The copy goes as a copy; the line itself stays, though a near line stands between the two."""
    x = "m n o p q r s t u"
    rows = [(1, x), (2, x[:-2]), (3, x), (4, "v " + x), (5, x[:-2]), (6, x + "\nfree")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    assert got == brute(rows) == {1: x, 2: "", 3: "", 4: "", 5: "", 6: "free"}


def test_null_ids_repeats_and_no_rows(spark):
    schema = "doc_id long, text string"
    got = line_dedup.dedup_lines(spark.createDataFrame([(None, "x y"), (1, "x y\nz"), (1, "other"), (2, "m"), (2, "m")], schema)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, "x y"), (1, "other"), (1, "z"), (2, "m"), (2, "m")]
    assert line_dedup.dedup_lines(spark.createDataFrame([], schema)).count() == 0
    for bad in ({"max_edits": 2}, {"min_words": 1}):
        with pytest.raises(ValueError):
            line_dedup.dedup_lines(spark.createDataFrame([], schema), **bad)


def test_one_edit_lies_in_a_shared_region():
    words = [str(i).encode() for i in range(40)]
    for n in range(7, 30):
        a = words[:n]
        for p in range(n + 1):
            longer, other = a[:p] + [b"x"] + a[p:], a[:p] + [b"x"] + a[p + 1 :]
            for b in (longer, *([other] if p < n else [])):
                h = line_dedup.Hashes([a, b])
                line, key, first, last = h.region_keys()
                shared = np.isin(key, key[line == 0]) & (line == 1)
                assert np.any((first[shared] <= p) & (p < last[shared])), (n, p)
                assert line_dedup.within_one(a, b) and line_dedup.within_one(b, a)
                one, keys, role = h.variants(np.array([0, 1]), np.array([0, 0]), np.array([n, len(b)]))
                mine = {r: set(keys[(one == 0) & (role == r)].tolist()) for r in range(3)}
                its = {r: set(keys[(one == 1) & (role == r)].tolist()) for r in range(3)}
                assert (mine[2] & its[1]) if len(b) > n else (mine[0] & its[0])


def test_a_line_of_a_million_words(spark):
    words = [f"w{i}" for i in range(1_000_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:777_777] + ["new"] + words[777_777:])), (3, "\n".join(f"{k} of very many short lines" for k in range(20_000))), (4, "\n".join(f"{k // 2} of very many short lines" for k in range(20_000)))]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_removed, got[2].n_removed, got[2].text, got[4].n_removed, got[4].text) == (0, 1, "", 20_000, "")


def test_clashing_columns_and_ties(spark):
    df = spark.createDataFrame([(1, "a b", 5, b"x"), (1, "a b", 5, b"x"), (2, "a b", 5, b"x")], "doc_id long, text string, doc int, tag binary")
    got = line_dedup.dedup_lines(df.withColumns({"line": F.lit(1), "id": F.lit(2), "lines": F.lit(3)}))
    assert got.columns == ["doc_id", "text", "doc", "tag", "line", "id", "lines", "n_lines", "n_removed"]
    assert sorted((r.doc_id, r.text, r.doc, r.lines) for r in got.collect()) == [(1, "a b", 5, 3), (1, "a b", 5, 3), (2, "", 5, 3)]


def test_texts_are_read_twice_for_near_lines(spark, monkeypatch):
    scans, scan = [], line_dedup._scan
    monkeypatch.setattr(line_dedup, "_scan", lambda docs, each, schema: scans.append(schema) or scan(docs, each, schema))
    docs = spark.createDataFrame([(1, "a b c d e f g h i"), (2, "a b c d x f g h i"), (3, "other words")], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: 0, 2: 1, 3: 0} and len(scans) == 2
