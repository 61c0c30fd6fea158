"""Quality scores: random Fourier features, ridge regression, isotonic calibration."""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import require, stored

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "space", "newline", "stop", "comma", "bang", "bar",
    "symbol", "other_mark", "non_ascii", "entropy", "distinct", "repeats", "top_word", "marked_words", "longest_word",
)
FEATURES = 384
MAX_LABELLED = 200_000
BINS = 1024
LOW, HIGH = -0.5, 1.5


def _class(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode(), dtype=np.uint8)


_UPPER, _DIGIT, _SYMBOL = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789"), _class("#$%&*@^~<>{}[]\\_=+")
_OTHER = _class("\"'()/:;?-`")


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text; null and empty texts give zeros."""
    raw = (text or "").encode()
    n = len(raw)
    if not n:
        return [0.0] * len(STATISTICS)
    hist = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    share = hist[hist > 0] / n
    words = raw.split()
    m = max(len(words), 1)
    counts = Counter(words)
    top = max(counts.values(), default=0)
    marks = sum(c for w, c in counts.items() if not (w[-1:].isalnum() or w[-1] >= 128 or w[-1:] in b".,"))
    return [
        np.log1p(n), np.log1p(len(words)), (n - hist[32]) / m, hist[_UPPER].sum() / n, hist[_DIGIT].sum() / n, hist[32] / n,
        hist[10] / m, hist[46] / m, hist[44] / m, hist[33] / m, hist[124] / m, hist[_SYMBOL].sum() / m, hist[_OTHER].sum() / m,
        hist[128:].sum() / n, float(-(share * np.log(share)).sum()), len(counts) / m,
        sum(map(operator.eq, words, words[1:])) / m, top / m, marks / m, np.log1p(max(map(len, words), default=0)),
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put ``stats`` (array<float>) for every whole text in the text's place.

    A column ``stats`` of the input is replaced; null and empty texts have
    statistics of zeros.
    """
    docs = docs.drop("stats")
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text_col]

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pdf.drop(columns=text_col).assign(stats=[np.asarray(statistics(t), dtype=np.float32) for t in pdf[text_col].tolist()])

    require(docs, id_col, text_col)
    return docs.mapInPandas(measure, ", ".join([*kept, "stats array<float>"]))


class Model(NamedTuple):
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray
    seed: int


def _projection(seed: int, n: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies of a Gaussian kernel whose width is the root of the number of statistics."""
    rng = np.random.default_rng(seed)
    d = len(STATISTICS)
    return rng.standard_normal((d, n)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, n)


def _fourier(stats: np.ndarray, mean: np.ndarray, spread: np.ndarray, seed: int) -> np.ndarray:
    """cos(x W + b) and a constant; their dot products approximate the kernel."""
    w, b = _projection(seed)
    x = np.clip((stats - mean) / spread, -8, 8)
    return np.hstack([np.sqrt(2 / w.shape[1]) * np.cos(x @ w + b), np.ones((len(x), 1))])


def _matrix(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_list()).astype(np.float64) if len(column) else np.zeros((0, len(STATISTICS)))


def _normal_equations(rows: DataFrame, mean: np.ndarray, spread: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and z y: by partition, then of 16 groups of partitions, then of those."""

    def partial(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b, seen = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1), 0
        for pdf in parts:
            z = _fourier(_matrix(pdf["stats"]), mean, spread, seed)
            a += z.T @ z
            b += z.T @ pdf["quality"].to_numpy(float)
            seen += len(pdf)
        if seen:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId() % 16], "sums": [np.concatenate([a.ravel(), b]).tobytes()]})

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"sums": [sum(np.frombuffer(x) for x in pdf["sums"]).tobytes()]})

    sums = rows.mapInPandas(partial, "part int, sums binary").groupBy("part").applyInPandas(total, "sums binary").collect()
    n = FEATURES + 1
    all_sums = sum((np.frombuffer(r.sums) for r in sums), np.zeros(n * n + n))
    return all_sums[: n * n].reshape(n, n), all_sums[n * n :]


def isotonic(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Non-decreasing means nearest to sums / counts (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for s, c in zip(sums, counts, strict=True):
        blocks.append([s, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, c2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s2, blocks[-1][1] + c2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), s / c) for s, c, k in blocks]) if blocks else np.zeros(0)


def fit_quality(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", max_labelled: int = MAX_LABELLED, ridge: float = 1e-4, seed: int = 7) -> Model:
    """Fit on the labelled rows of ``measured``, less those that are held out.

    crc32(id as text) mod 3 deals the rows: 0 fits the ridge scores, 2 fits the
    calibration, 1 is never looked at.  At most about ``max_labelled`` rows
    (those of the smallest hashes) are used; what is summed does not depend on
    the number of rows.  Labels that are null are left out; without any label
    every score is 0.5.
    """
    require(labels, id_col, label_col)
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3
    known = labels.select(id_col, F.col(label_col).cast("double").alias("quality")).dropna().withColumn("fold", fold).filter("fold != 1")
    n = known.count()
    if n > max_labelled:
        known = known.filter(F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < int(max_labelled / n * (1 << 20)))
    rows = stored(measured.join(known, id_col).select("stats", "quality", "fold"))
    fit, calibrate = rows.filter("fold = 0"), rows.filter("fold = 2")
    d = len(STATISTICS)
    moments = fit.agg(*[f(F.col("stats")[i].cast("double")).alias(f"{k}{i}") for i in range(d) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([moments[f"m{i}"] or 0.0 for i in range(d)])
    spread = np.array([moments[f"s{i}"] or 1.0 for i in range(d)])
    a, b = _normal_equations(fit, mean, spread, seed)
    seen = a[-1, -1]
    weights = np.linalg.solve(a + ridge * max(seen, 1) * np.eye(len(a)), b) if seen else np.zeros(FEATURES + 1)
    model = Model(mean, spread, weights, np.zeros(0), np.zeros(0), seed)
    held = measured.sparkSession.sparkContext.broadcast(model)

    def bins(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            at = (np.clip(raw_scores(held.value, _matrix(pdf["stats"])), LOW, HIGH) - LOW) / (HIGH - LOW) * (BINS - 1)
            yield pd.DataFrame({"bin": np.round(at).astype(int), "y": pdf["quality"].to_numpy(float)})

    hist = sorted(calibrate.mapInPandas(bins, "bin int, y double").groupBy("bin").agg(F.sum("y").alias("y"), F.count("y").alias("n")).collect())
    if not hist:
        return model
    values = isotonic(np.array([h.y for h in hist]), np.array([float(h.n) for h in hist]))
    return model._replace(knots=np.array([h.bin for h in hist]) / (BINS - 1) * (HIGH - LOW) + LOW, values=values)


def raw_scores(model: Model, stats: np.ndarray) -> np.ndarray:
    return _fourier(stats, model.mean, model.spread, model.seed) @ model.weights


def calibrated(model: Model, stats: np.ndarray) -> np.ndarray:
    """Scores of 0 to 1; calibrated means between the means of neighbouring bins."""
    raw = raw_scores(model, stats)
    if len(model.knots):
        return np.interp(raw, model.knots, model.values)
    return np.clip(raw, 0, 1) if model.weights.any() else np.full(len(raw), 0.5)


def score_quality(measured: DataFrame, model: Model, score_col: str = "score") -> DataFrame:
    """Replace ``stats``, and a column of the score's name, by the score: 0 to 1, ties and empty texts included."""
    held = measured.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(stats: pd.Series) -> pd.Series:
        return pd.Series(calibrated(held.value, _matrix(stats)))

    return measured.withColumn(score_col, score("stats")).drop("stats")


def keep_quality(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores ``threshold`` or more, in place, without a shuffle."""
    require(docs, text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def keep(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            if len(pdf):
                yield pdf[calibrated(held.value, np.array([statistics(t) for t in pdf[text_col].tolist()], dtype=np.float32).astype(float)) >= threshold]

    return docs.mapInPandas(keep, docs.schema)
