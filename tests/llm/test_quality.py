import binascii

import numpy as np

from pulsegrid.llm import quality, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_contract(spark):
    got = {r.doc_id: r for r in queries.op5_quality(spark, SF).collect()}
    assert len(got) == 1000
    right = []
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        held = binascii.crc32(str(r.doc_id).encode()) % 3 == 1
        s = got[r.doc_id]
        assert s.held_out == held and 0 <= s.score <= 1 and s.predicted == (s.score >= 0.5)
        if held:
            right.append(s.predicted == r.quality)
    assert np.mean(right) > 0.95


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    measured = quality.document_statistics(docs.select("doc_id", "text"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - quality, quality) as quality")
    one, two = (quality.fit_quality(measured, x) for x in (labels, flipped))
    assert np.allclose(one.weights, two.weights) and np.array_equal(one.values, two.values)


def test_odd_texts_and_no_labels(spark):
    rows = [(1, None, 1), (2, "", 1), (None, "a b", 1), (3, "x" * 500_000, 1), (3, "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    measured = quality.document_statistics(docs)
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit_quality(measured, none)
    assert [r.score for r in quality.score_quality(measured, model).collect()] == [0.5] * 5
    assert quality.score_quality(quality.document_statistics(docs.limit(0)), model).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, 1), (2, 1), (9, 0)], "doc_id long, quality int")
    scored = quality.score_quality(measured, quality.fit_quality(measured, nulls)).collect()
    assert all(0 <= r.score <= 1 for r in scored)
    assert quality.keep_quality(docs, model).count() == 5


def test_isotonic_is_the_least_squares_fit():
    got = quality.isotonic(np.array([1.0, 0, 2, 1]), np.array([1.0, 1, 2, 2]))
    assert np.allclose(got, [0.5, 0.5, 0.75, 0.75])


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((40, len(quality.STATISTICS)))
    z = quality._fourier(x, np.zeros(x.shape[1]), np.ones(x.shape[1]), 1)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * x.shape[1]))
    assert np.abs(z @ z.T - exact).mean() < 0.06


def test_query_matches_plain_ridge_and_isotonic_fits(spark):
    """The whole query against NumPy: moments, kernel features, one ridge solve over all rows, calibration by bins."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    stats = np.array([quality.statistics(d.text) for d in docs], dtype=np.float32).astype(float)
    fold = np.array([binascii.crc32(str(d.doc_id).encode()) % 3 for d in docs])
    y = np.array([labels.get(d.doc_id, -1) for d in docs], dtype=float)
    fit, late = (y >= 0) & (fold == 0), (y >= 0) & (fold == 2)
    mean, spread = stats[fit].mean(axis=0), stats[fit].std(axis=0)
    rng = np.random.default_rng(7)
    w, b = rng.standard_normal((stats.shape[1], 384)) / np.sqrt(stats.shape[1]), rng.uniform(0, 2 * np.pi, 384)
    z = np.hstack([np.sqrt(2 / 384) * np.cos(np.clip((stats - mean) / np.where(spread > 0, spread, 1), -8, 8) @ w + b), np.ones((len(stats), 1))])
    weights = np.linalg.solve(z[fit].T @ z[fit] + 1e-4 * fit.sum() * np.eye(385), z[fit].T @ y[fit])
    raw = z @ weights
    bins = np.round((np.clip(raw, -0.5, 1.5) + 0.5) / 2 * 1023).astype(int)
    knots = np.unique(bins[late])
    means = quality.isotonic(np.array([y[late][bins[late] == k].sum() for k in knots]), np.array([float((bins[late] == k).sum()) for k in knots]))
    want = np.interp(raw, knots / 1023 * 2 - 0.5, means)
    got = {r.doc_id: r.score for r in queries.op5_quality(spark, SF).collect()}
    # sums in another order move a raw score a little, and a bin's border with it
    assert np.mean(np.abs([got[d.doc_id] for d in docs] - want) < 1e-6) > 0.99


def test_a_column_of_the_name_of_the_statistics(spark):
    docs = spark.createDataFrame([(1, "a b", "mine", 3)], "doc_id long, text string, stats string, score int")
    measured = quality.document_statistics(docs)
    assert measured.columns == ["doc_id", "score", "stats"]
    model = quality.fit_quality(measured, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert quality.keep_quality(docs, model).columns == docs.columns
