import re

from pulsegrid.llm import decontaminate

W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return W.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute(text, items, window=13):
    w, hit, seen = words(text), set(), set()
    for i, t in items:
        own = words(t)
        n = min(window, len(own))
        wins = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else set()
        for k in range(len(w) - n + 1 if n else 0):
            if tuple(w[k : k + n]) in wins:
                hit |= {*range(k, k + n)}
                seen.add("" if i is None else str(i))
    return len(w), len(hit), sorted(seen)


ITEMS = [
    (1, " ".join(f"w{i}" for i in range(30))),
    (2, "Ünder the SEA, again"),
    (3, None),
    (4, "..."),
    (5, "a " * 40),
    (10, " ".join(f"w{i}" for i in range(10, 24))),
    (10, "other words of one more row " * 3),
    (None, "short null id"),
]
DOCS = [
    None,
    "",
    "x " + " ".join(f"W{i}!" for i in range(5, 19)) + " y",
    "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12",
    "say ünder-the sea\u00a0again " * 2,
    "under the sea again. Ünder the sea,again",
    "a " * 100,
    "a " * 12,
    " ".join(f"w{i}" for i in range(30)) + " gap " + " ".join(f"w{i}" for i in range(12, 25)),
    "short null\nid",
    "pad " * 50_000 + " ".join(f"w{i}" for i in range(30)),
]


def run(spark, **more):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(DOCS)], "doc_id long, text string, hits int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    return {r.doc_id: r for r in decontaminate.contamination(decontaminate.find_overlaps(docs, items, **more)).collect()}


def test_matches_brute_force_in_one_block_or_many(spark):
    for more in ({}, {"block_bytes": 200}):
        got = run(spark, **more)
        for i, t in enumerate(DOCS):
            n, hit, seen = brute(t, ITEMS)
            r = got[i]
            assert (r.n_words, r.n_hit, r.items) == (n, hit, seen), (i, more)
            assert r.contaminated == (hit > 0 and 20 * hit >= n)


def test_spans_are_those_of_the_given_text(spark):
    got = run(spark)[2]
    assert [DOCS[2][s.start : s.end] for s in got.spans] == [" ".join(f"W{i}!" for i in range(5, 19))[:-1]]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(decontaminate.find_overlaps(docs, none)).first()
    assert (got.n_words, got.n_hit, got["items"], got.contaminated) == (2, 0, [], False)
    assert decontaminate.find_overlaps(docs.limit(0), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_repetitive_items_and_texts_take_linear_time():
    import time

    items = [("a", [b"go"] * 20_000), ("b", [b"go"] * 50), ("c", [b"go", b"to"] * 9), ("d", [b"go"] * 7)]
    matcher = decontaminate.Matcher(items, 13)
    began = time.time()
    spans, found = matcher.runs([b"go"] * 20_000 + [b"to", b"go"] * 10)
    assert time.time() - began < 10
    assert found == {"a", "b", "c", "d"} and decontaminate._merged(spans) == [0, 20_020]
    assert matcher.runs([b"go"] * 6) == ([], set())
    assert matcher.runs([b"go"] * 8) == ([(0, 7), (1, 8)], {"d"})


def test_one_block_of_items_at_a_time(spark, monkeypatch):
    from pyspark import Broadcast, SparkContext

    live, most, read = set(), [], []
    make, end = SparkContext.broadcast, Broadcast.destroy
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: (b := make(self, value), live.add(id(b)), most.append(len(live)), read.append(len(value)))[0])
    monkeypatch.setattr(Broadcast, "destroy", lambda self, blocking=False: (live.discard(id(self)), end(self, blocking))[1])
    words = [f"w{k}" for k in range(400)]
    items = spark.createDataFrame([(None if k == 3 else k, " ".join(words[20 * k : 20 * k + 20])) for k in range(20)], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(words[5:48])), (2, "x " + " ".join(words[60:80]) + " y"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.find_overlaps(docs, items, block_bytes=300).collect()}
    whole = {r.doc_id: r for r in decontaminate.find_overlaps(docs, items).collect()}
    assert max(most[:-1]) == 1 and len(most) > 4 and max(read[:-1]) < 20
    assert {d: (r.hits, r.items) for d, r in got.items()} == {d: (r.hits, r.items) for d, r in whole.items()}
    assert whole[2].items == [""] and whole[1].items == ["0", "1"] and whole[3].hits == []
