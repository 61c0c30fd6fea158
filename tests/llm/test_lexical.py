import math
import random
import re
from collections import Counter

import pytest

from pulsegrid.llm import lexical


def brute(docs, queries, k):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    counts = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for q, text in queries:
        asked.setdefault(q, set()).update(terms(text))
    out = []
    for q, wanted in asked.items():
        scored = []
        for d, c in counts:
            n = sum(c.values())
            score = 0
            for t in wanted & c.keys():
                m = 100 - 90 + (90 * n * n_docs) // total
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(q, i + 1, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(spark, docs, queries, **params):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, score long")
    q = spark.createDataFrame(queries, "item_id string, text string")
    return sorted((tuple(r) for r in lexical.search(d, q, **params).collect()), key=repr)


EDGES = [(1, "Hello World"), (2, None), (3, ""), (4, "... !"), (5, "hello"), (5, "hello"), (6, "HELLO hello wörld WÖRLD"), (None, "hello"), (7, "café 42 x9"), (-3, "hello")]


def test_edges_equal_brute_force(spark):
    queries = [("a", "Hello, hello"), ("b", "wörld café"), ("b", "42"), ("c", None), ("d", "nothing here"), ("e", "?"), ("f", "x9 x9 WORLD")]
    for k in (1, 2, 10):
        assert found(spark, EDGES, queries, k=k) == brute(EDGES, queries, k)


@pytest.mark.parametrize("seed", [0, 1])
def test_random_texts_equal_brute_force_in_blocks(spark, seed, monkeypatch):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    docs = [(k, " ".join(rng.choices(words, [1 / (i + 1) for i in range(300)], k=rng.choice([1, 5, 40, 900])))) for k in range(150)]
    docs += [(1000 + k, docs[7][1]) for k in range(40)]  # a group of copies: ties
    queries = [(str(q), " ".join(rng.sample(words, 12))) for q in range(25)]
    expect = brute(docs, queries, 10)
    assert found(spark, docs, queries) == expect
    assert found(spark, docs, queries, block_terms=30) == expect


def test_bounds_are_never_below_scores_and_spare_work():
    rng = random.Random(3)
    docs = [" ".join(rng.choices([f"w{k}" for k in range(600)], [1 / (k + 5) for k in range(600)], k=60)) for _ in range(400)]
    chunk = lexical._Chunk(docs)
    query = [b"w1", b"w2", b"w77", b"w399", b"none"]
    scorer = lexical._Scorer([(0, query)], {t: 5 for t in query}, 400, 24_000, 10)
    offered = []
    scorer._offer, plain = lambda j, score, doc: (offered.append((score, doc)), plain(j, score, doc)), scorer._offer
    scorer.add(list(range(400)), chunk)
    impact = scorer._impacts(chunk)
    for texts, sketch in scorer._sketches(chunk, impact):
        seen = scorer._bounds(sketch) @ scorer.weights
        for i, bound in zip(texts.tolist(), seen.tolist(), strict=True):
            exact = sum(int(scorer.weights[scorer.place[chunk.terms[t]]]) * int(v) for t, v in zip(chunk.term[chunk.starts[i] : chunk.ends[i]], impact[chunk.starts[i] : chunk.ends[i]], strict=True) if chunk.terms[t] in scorer.place)
            assert bound >= exact
    assert len(offered) < 200 and len(scorer.heaps[0]) == 10


def test_empty_tables(spark):
    assert found(spark, [], [("a", "b")]) == []
    assert found(spark, EDGES, []) == []
