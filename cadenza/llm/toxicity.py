"""Toxicity (operator 1): cumulative-link ordinal regression over sparse text features.

P(grade > k) = sigmoid(w x - t_k) with one weight vector for all thresholds t_1 <= t_2 <= ...
The severity is the expected grade, the sum of these probabilities.

Features are hashed words and word beginnings. Spark counts in how many labelled texts of each
side every feature occurs and keeps the features that speak for a grade above 0. A text's
value of a feature is 1 + log(1 + its occurrences per 100 words), and 0 where it is absent.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import _PUNCT, BROADCAST_ROWS, bounded_batches, mix64, word_chunks

BUCKETS = 1 << 20
#: Labelled rows of each side (grade 0, above 0) that train at most, drawn by hash of the id.
TRAIN_ROWS = 10_000
#: Features kept at most, the texts above grade 0 each must occur in, and its least log odds.
MAX_FEATURES, MIN_TEXTS, MIN_ODDS = 4_096, 4, 2.5
#: Word beginnings, in bytes.
BEGINNINGS = (4, 5)


def _buckets(words) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every feature: the word and, where it is longer, its beginnings."""
    lens = words.end - words.start
    word, bucket = [np.arange(len(lens))], [words.hashes(lower=True)]
    for n in BEGINNINGS:
        at = np.flatnonzero(lens > n)
        word.append(at)
        bucket.append(mix64(words.hashes(lower=True, most=n)[at] + np.uint64(n)))
    return np.concatenate(word), (np.concatenate(bucket) % np.uint64(BUCKETS)).astype(np.int64)


def _texts_with(batches):
    """(bucket, high, n): labelled texts with the feature, by side."""
    import pyarrow as pa

    for batch in batches:
        high = batch.column("grade").to_numpy(zero_copy_only=False) > 0
        keys = []
        for words in word_chunks(batch.column("text"), _PUNCT):
            word, bucket = _buckets(words)
            pairs = np.unique((words.row[word] + words.lo) * BUCKETS + bucket)
            keys.append((pairs % BUCKETS) * 2 + high[pairs // BUCKETS])
        key, n = np.unique(np.concatenate(keys or [np.zeros(0, np.int64)]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(key // 2), pa.array(key % 2), pa.array(n)],
                                         names=["bucket", "high", "n"])


def _values(words, index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse values of a chunk: (row, feature, value, occurrences)."""
    word, bucket = _buckets(words)
    feature = index[bucket]
    own = feature >= 0
    width = int(index.max()) + 1 if len(index) else 1
    pairs, n = np.unique(words.row[word[own]] * max(width, 1) + feature[own], return_counts=True)
    row = pairs // max(width, 1)
    return row, pairs % max(width, 1), 1 + np.log1p(100.0 * n / words.count[row]), n


def _index(features: np.ndarray) -> np.ndarray:
    index = np.full(BUCKETS, -1, np.int64)
    index[features] = np.arange(len(features))
    return index


def _examples(batches, features: np.ndarray):
    """(grade, n_words, features, values) of the training texts."""
    import pyarrow as pa

    index = _index(features)
    for batch in batches:
        for words in word_chunks(batch.column("text"), _PUNCT):
            row, feature, value, _ = _values(words, index)
            off = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=words.rows)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade").slice(words.lo, words.rows), pa.array(words.count),
                 pa.ListArray.from_arrays(pa.array(off), pa.array(feature)),
                 pa.ListArray.from_arrays(pa.array(off), pa.array(value))],
                names=["grade", "n_words", "features", "values"])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_ordinal(row: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, width: int,
                steps: int = 600, rate: float = 0.1, shrink: float = 2e-6) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient descent (Adam) on the cumulative-link likelihood.

    The thresholds are the first one and positive steps, so they keep their order.
    """
    top, n = int(grade.max()), len(grade)
    share = np.array([(grade > k).mean() for k in range(top)])
    start = -np.log(share / (1 - share))
    gap = np.maximum(np.diff(start), 1e-3)
    theta = np.concatenate((np.zeros(width), start[:1], np.log(np.expm1(gap))))
    m, v = np.zeros_like(theta), np.zeros_like(theta)

    def thresholds(t):
        return np.cumsum(np.concatenate((t[width:width + 1], np.log1p(np.exp(t[width + 1:])))))

    for step in range(1, steps + 1):
        w, cut = theta[:width], thresholds(theta)
        eta = np.bincount(row, w[feature] * value, minlength=n)
        edge = np.concatenate(([-np.inf], cut, [np.inf]))
        up, low = _sigmoid(edge[grade + 1] - eta), _sigmoid(edge[grade] - eta)
        p = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / p, low * (1 - low) / p
        g_eta = d_up - d_low                                  # d(-log p) / d eta
        g_w = np.bincount(feature, g_eta[row] * value, minlength=width) / n + shrink * w
        g_cut = (np.bincount(grade, d_low, minlength=top + 1)[1:] - np.bincount(grade, d_up, minlength=top + 1)[:-1]) / n
        tail = np.cumsum(g_cut[::-1])[::-1]
        grad = np.concatenate((g_w, tail[:1], tail[1:] * _sigmoid(theta[width + 1:])))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return theta[:width], thresholds(theta)


class ToxicityModel:
    """Feature buckets, their weights, and the thresholds of the grades."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, cuts: np.ndarray):
        self.features, self.weights, self.cuts = features, weights, cuts

    @staticmethod
    def fit(labelled: DataFrame, levels: tuple[float, ...] = (0.5, 0.9)) -> "ToxicityModel":
        """From ``(text, grade)``; null grades and texts are left out.

        Grades are integers from 0. If only 0 and 1 occur, the texts of grade 1 are graded by the
        sum of their features' values (how many there are, and how dense): one grade more above
        each of the quantiles ``levels``. Without texts on both sides nothing is learned and every
        severity is 0.
        """
        use = labelled.where("grade IS NOT NULL AND text IS NOT NULL").select("text", F.col("grade").cast("int").alias("grade"))
        sides = {r["high"]: r["n"] for r in use.groupBy((F.col("grade") > 0).alias("high")).agg(F.count(F.lit(1)).alias("n")).collect()}
        none = ToxicityModel(np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
        if not sides.get(True) or not sides.get(False):
            return none
        counts = use.mapInArrow(_texts_with, "bucket bigint, high bigint, n bigint").groupBy("bucket").agg(
            F.sum(F.when(F.col("high") == 1, F.col("n")).otherwise(0)).alias("hi"),
            F.sum(F.when(F.col("high") == 0, F.col("n")).otherwise(0)).alias("lo"))
        odds = F.log((F.col("hi") + 0.5) / F.lit(sides[True] + 1.0)) - F.log((F.col("lo") + 0.5) / F.lit(sides[False] + 1.0))
        best = (counts.withColumn("odds", odds).where((F.col("hi") >= MIN_TEXTS) & (F.col("odds") >= MIN_ODDS))
                .orderBy(F.desc(F.col("odds") * F.sqrt("hi")), "bucket").limit(MAX_FEATURES).collect())
        features = np.array([r["bucket"] for r in best], np.int64)
        if not len(features):
            return none
        rows = use.mapInArrow(lambda it: _examples(it, features),
                              "grade int, n_words bigint, features array<bigint>, values array<double>").collect()
        rows = sorted(rows, key=lambda r: (r["grade"], r["n_words"], r["features"], r["values"]))
        grade = np.array([r["grade"] for r in rows])
        row = np.repeat(np.arange(len(rows)), [len(r["features"]) for r in rows])
        feature = np.array([x for r in rows for x in r["features"]], np.int64)
        value = np.array([x for r in rows for x in r["values"]])
        if grade.max() == 1:
            total = np.bincount(row, value, minlength=len(rows))
            for cut in np.quantile(total[grade > 0], levels):
                grade = grade + ((grade > 0) & (total > cut))
            grade = np.unique(grade, return_inverse=True)[1]
        return ToxicityModel(features, *fit_ordinal(row, feature, value, grade, len(features)))


def _score(batches, model: ToxicityModel):
    import pyarrow as pa

    index = _index(model.features)
    for batch in batches:
        for words in word_chunks(batch.column("text"), _PUNCT):
            row, feature, value, n = _values(words, index)
            eta = np.bincount(row, model.weights[feature] * value, minlength=words.rows)
            above = _sigmoid(eta[:, None] - model.cuts[None, :])      # P(grade > k)
            above = above if len(model.cuts) else np.zeros((words.rows, 1))
            chance = -np.diff(np.concatenate((np.ones((words.rows, 1)), above, np.zeros((words.rows, 1))), 1), axis=1)
            part = batch.slice(words.lo, words.rows)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in part.schema.names if c != "text"), pa.array(above.sum(1)),
                 pa.array(chance.argmax(1).astype(np.int64)), pa.array(above[:, 0] >= 0.5),
                 pa.array(np.bincount(row, n, minlength=words.rows).astype(np.int64))],
                names=[*(c for c in part.schema.names if c != "text"), "severity", "grade", "toxic", "n_hits"])


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``(doc_id, severity, grade, toxic, n_hits)`` per row: expected grade, likeliest grade,
    whether a grade above 0 is likelier than not, and occurrences of the model's features.

    Null and empty texts are scored by the thresholds alone. Rows may repeat, ids be null.
    """
    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(lambda it: _score(it, model),
                             "doc_id bigint, severity double, grade bigint, toxic boolean, n_hits bigint")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int = TRAIN_ROWS) -> DataFrame:
    """``(text, grade)`` of at most about ``most`` labelled rows of each side, by hash of the id.

    Of labels that repeat an id the largest counts; null labels and ids are left out.
    """
    one = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col(label).cast("int")).alias("grade"))
    sides = {r["high"]: r["n"] for r in one.groupBy((F.col("grade") > 0).alias("high")).agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)).cast("double") / F.lit(float(1 << 30))
    part = F.when(F.col("grade") > 0, F.lit(min(1.0, most / sides.get(True, 1)))).otherwise(
        F.lit(min(1.0, most / sides.get(False, 1))))
    assert 3 * most < BROADCAST_ROWS
    return docs.select("doc_id", "text").join(F.broadcast(one.where(draw < part)), "doc_id").select("text", "grade")


def toxicity_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Severity of every document, learned from the labelled ones."""
    bounded_batches(docs.sparkSession)
    return score_toxicity(docs, ToxicityModel.fit(training_rows(docs, labels, "toxic")))
