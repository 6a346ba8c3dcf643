"""Quality rules (operator 8): gradient-boosted trees over document statistics.

The trees are boosted on a bounded sample of labelled rows (logistic loss, histograms), with
monotonic constraints: a split on a constrained feature is taken only if its two values are in
the asked order, and the values below it stay on their side of the middle. All trees are
flattened into numpy arrays of nodes, which score all rows of a batch at once.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import _ODD, _SPACE, bounded_batches, chain, mix64, word_chunks
from cadenza.llm.toxicity import training_rows

#: Labelled rows of each side that train at most, drawn by hash of the id.
TRAIN_ROWS = 10_000
TREES, DEPTH, RATE, BINS, LEAF_ROWS, RIDGE = 60, 3, 0.2, 64, 20, 1.0
#: A document needs so many words, and at most this share of words in repeated windows.
MIN_WORDS, MAX_REPEAT = 50, 0.5
SYMBOLS = b"#*$%&|<>"

#: Features, and the direction in which quality may move with them (0: either).
FEATURES = {
    "n_words": 0, "mean_word": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1,
    "upper_share": -1, "digit_share": 0, "distinct_share": 0, "words_per_line": 0, "top_word_share": -1,
}


def _flag(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SYMBOL, _UPPER, _DIGIT = _flag(SYMBOLS), _flag(bytes(range(65, 91))), _flag(bytes(range(48, 58)))
_LEADS = np.array([b & 0xC0 != 0x80 for b in range(256)])


def _per_row(words, flags: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[words.offsets[1:]] - total[words.offsets[:-1]]


def _lines(words) -> tuple[np.ndarray, np.ndarray]:
    """Per row: lines with a word, and distinct ones among them (by 64-bit hash)."""
    data, off = words.data, words.offsets
    if not len(data):
        return np.zeros(words.rows, np.int64), np.zeros(words.rows, np.int64)
    start = np.unique(np.concatenate((off[:-1][off[:-1] < len(data)], np.flatnonzero(data[:-1] == 10) + 1)))
    length = np.diff(np.append(start, len(data)))
    at = np.arange(len(data)) - np.repeat(start, length)
    power = np.cumprod(np.full(int(length.max()), _ODD, np.uint64))
    term = np.where(data == 10, np.uint64(0), (data.astype(np.uint64) + np.uint64(1)) * power[at])
    hashed = mix64(np.add.reduceat(term, start))
    worded = np.add.reduceat(~_SPACE[data], start) > 0
    row = np.searchsorted(off, start[worded], "right") - 1
    key = chain([row.astype(np.uint64), hashed[worded]])
    _, first = np.unique(key, return_index=True)
    return np.bincount(row, minlength=words.rows), np.bincount(row[first], minlength=words.rows)


def _repeated(words, h: np.ndarray) -> np.ndarray:
    """Per row: words in windows of three words that the row holds twice or more."""
    if len(h) < 3:
        return np.zeros(words.rows, np.int64)
    at = np.flatnonzero(words.row[:-2] == words.row[2:])
    key = chain([words.row[at].astype(np.uint64), h[at], h[at + 1], h[at + 2]])
    _, inverse, n = np.unique(key, return_inverse=True, return_counts=True)
    twice = at[n[inverse] > 1]
    marked = np.zeros(len(h), bool)
    for j in range(3):
        marked[twice + j] = True
    return np.bincount(words.row[marked], minlength=words.rows)


def statistics(words) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The base counts of a chunk's rows, and the feature matrix [row, feature]."""
    n, h = words.count, words.hashes(lower=False)
    lines, distinct_lines = _lines(words)
    base = {
        "n_words": n, "word_chars": _per_row(words, _LEADS[words.data] & ~_SPACE[words.data]),
        "n_symbols": _per_row(words, _SYMBOL[words.data]), "n_dup_lines": lines - distinct_lines,
        "n_repeat_words": _repeated(words, h),
    }
    key, first, times = np.unique(chain([words.row.astype(np.uint64), h]), return_index=True, return_counts=True)
    distinct = np.bincount(words.row[first], minlength=words.rows)
    top = np.zeros(words.rows)
    np.maximum.at(top, words.row[first], times)
    some, chars = np.maximum(n, 1), np.maximum(base["word_chars"], 1)
    return base, np.column_stack([
        n, base["word_chars"] / some, base["n_symbols"] / some, base["n_dup_lines"] / np.maximum(lines, 1),
        base["n_repeat_words"] / some, _per_row(words, _UPPER[words.data]) / chars,
        _per_row(words, _DIGIT[words.data]) / chars, distinct / some, n / np.maximum(lines, 1), top / some,
    ]).astype(float)


class Forest:
    """All trees as arrays of nodes: leaves point to themselves."""

    def __init__(self, feature, threshold, left, right, value, roots, bias: float):
        self.feature, self.threshold, self.left, self.right, self.value = feature, threshold, left, right, value
        self.roots, self.bias = roots, bias

    def raw(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            go = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(go, self.left[at], self.right[at])
        return self.bias + self.value[at].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -60, 60)))


def _grow(binned, edges, grad, hess, signs):
    """One tree: lists (feature, threshold, left, right, value), root first."""
    nodes: list[list] = []

    def value(g, h, low, high):
        return float(np.clip(-g / (h + RIDGE), low, high))

    def build(rows, depth, low, high) -> int:
        own = len(nodes)
        g, h = grad[rows].sum(), hess[rows].sum()
        nodes.append([0, np.inf, own, own, RATE * value(g, h, low, high)])
        if depth == DEPTH or len(rows) < 2 * LEAF_ROWS:
            return own
        best = (1e-6, None)
        for j, sign in enumerate(signs):
            b = binned[rows, j]
            gs = np.cumsum(np.bincount(b, grad[rows], minlength=BINS))[:-1]
            hs = np.cumsum(np.bincount(b, hess[rows], minlength=BINS))[:-1]
            ns = np.cumsum(np.bincount(b, minlength=BINS))[:-1]
            gain = gs ** 2 / (hs + RIDGE) + (g - gs) ** 2 / (h - hs + RIDGE) - g ** 2 / (h + RIDGE)
            vl = np.clip(-gs / (hs + RIDGE), low, high)
            vr = np.clip(-(g - gs) / (h - hs + RIDGE), low, high)
            ok = (ns >= LEAF_ROWS) & (len(rows) - ns >= LEAF_ROWS) & (sign * (vr - vl) >= 0)
            gain = np.where(ok, gain, -1.0)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), (j, k, sign, float(vl[k]), float(vr[k])))
        if best[1] is None:
            return own
        j, k, sign, vl, vr = best[1]
        mid = (vl + vr) / 2
        bounds = [(low, high), (low, high)]
        if sign > 0:
            bounds = [(low, mid), (mid, high)]
        elif sign < 0:
            bounds = [(mid, high), (low, mid)]
        go = binned[rows, j] <= k
        nodes[own][:2] = [j, float(edges[j][k])]
        nodes[own][2] = build(rows[go], depth + 1, *bounds[0])
        nodes[own][3] = build(rows[~go], depth + 1, *bounds[1])
        return own

    build(np.arange(len(binned)), 0, -np.inf, np.inf)
    return nodes


def fit_forest(x: np.ndarray, y: np.ndarray, signs: list[int]) -> Forest:
    """Boosted trees for P(y = 1); ``signs`` per feature: +1 rising, -1 falling, 0 free."""
    edges = []
    for j in range(x.shape[1]):
        cut = np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1]))
        edges.append(np.append(cut, np.full(BINS - 1 - len(cut), np.inf)))
    binned = np.column_stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(x.shape[1])])
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    bias = float(np.log(share / (1 - share)))
    raw, flat, roots = np.full(len(y), bias), [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        nodes = _grow(binned, edges, p - y, np.maximum(p * (1 - p), 1e-9), signs)
        shift = len(flat)
        roots.append(shift)
        flat += [[f, t, left + shift, right + shift, v] for f, t, left, right, v in nodes]
        tree = np.array(flat[shift:], float)
        one = Forest(tree[:, 0].astype(int), tree[:, 1], tree[:, 2].astype(int) - shift,
                     tree[:, 3].astype(int) - shift, tree[:, 4], np.zeros(1, int), 0.0)
        raw = raw + one.raw(x)
    a = np.array(flat, float)
    return Forest(a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4],
                  np.array(roots), bias)


def _features(batches):
    """(label, features) of the training texts."""
    import pyarrow as pa

    for batch in batches:
        for words in word_chunks(batch.column("text")):
            _, x = statistics(words)
            off = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade").slice(words.lo, words.rows), pa.ListArray.from_arrays(off, pa.array(x.ravel()))],
                names=["label", "x"])


def fit_quality(labelled: DataFrame) -> Forest | None:
    """From ``(text, grade)`` with grade 0 (bad) or above (good); None without both sides."""
    rows = labelled.mapInArrow(_features, "label int, x array<double>").collect()
    rows = sorted((r["label"] > 0, tuple(r["x"])) for r in rows)
    y = np.array([r[0] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return None
    return fit_forest(np.array([r[1] for r in rows]), y, list(FEATURES.values()))


def _judge(batches, forest: Forest | None):
    import pyarrow as pa

    for batch in batches:
        for words in word_chunks(batch.column("text")):
            base, x = statistics(words)
            score = forest.score(x) if forest is not None else np.ones(len(x))
            n = base["n_words"]
            failed = (n < MIN_WORDS) | (100 * base["n_repeat_words"] > 100 * MAX_REPEAT * n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(words.lo, words.rows), *(pa.array(v.astype(np.int64)) for v in base.values()),
                 pa.array(failed), pa.array(~failed & (score >= 0.5)), pa.array(score)],
                names=["doc_id", *base, "base_failed", "kept", "score"])


def quality_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, base rules and verdict of every document.

    Null and empty texts have no words and fail the base rules. Without labels of both kinds
    the base rules alone decide. Rows may repeat, ids be null; an empty table gives none.
    """
    bounded_batches(docs.sparkSession)
    forest = fit_quality(training_rows(docs, labels, "quality", TRAIN_ROWS).where("text IS NOT NULL"))
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(
        lambda it: _judge(it, forest),
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean, score double")
