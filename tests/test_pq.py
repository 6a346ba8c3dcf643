"""Product quantisation against a plain version, and its edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import knn as K
from cadenza.operators import pq as Q

DIM, PARTS = 8, 4
NAMES = dict(index_key="link", index_vec="v")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(160, DIM)).round(3)
    x[100:130] = x[0]                                  # copies: ties in estimate and score
    rows = [(f"k{i:03d}", r.tolist()) for i, r in enumerate(x)]
    rows += [("bad1", None), ("bad2", [1.0] * 3), ("bad3", [0.0] * DIM), ("bad4", [float("nan")] * DIM), ("bad5", [None] * DIM)]
    index = spark.createDataFrame(rows, "link string, v array<double>").repartition(5).checkpoint()
    queries = index.select(F.col("link").alias("query_id"), F.col("v").alias("query_vec"))
    return x, index, queries


def plain_books(x, order, entries, rounds):
    ints = np.floor(x / np.linalg.norm(x, axis=1, keepdims=True) * Q.SCALE).astype(int).reshape(len(x), PARTS, -1)
    books = ints[order[:entries]].transpose(1, 0, 2).copy()
    code = lambda: np.array([[min(range(len(books[p])), key=lambda e: (((r[p] - books[p, e]) ** 2).sum(), e))
                              for p in range(PARTS)] for r in ints])
    for _ in range(rounds):
        codes = code()
        for p in range(PARTS):
            for e in set(codes[:, p]):
                books[p, e] = ints[codes[:, p] == e][:, p].sum(axis=0) // (codes[:, p] == e).sum()
    return ints.reshape(len(x), -1), books, code()


def test_books_codes_and_answers_equal_a_plain_version(spark, data, tmp_path):
    import hashlib

    x, index, queries = data
    order = sorted(range(len(x)), key=lambda i: (hashlib.md5(f"k{i:03d}".encode()).hexdigest()[:8], f"k{i:03d}"))
    ints, books, codes = plain_books(x, order, 12, 2)
    got = Q.train_books(index, dim=DIM, parts=PARTS, entries=12, rounds=2, **NAMES)
    assert (got.entries == books).all()
    path = Q.write_codes(index, got, str(tmp_path / "pq"), **NAMES)
    assert (Q.Books.load(spark, f"{path}/books").entries == books).all()
    stored = spark.read.parquet(f"{path}/codes")
    assert {r.link: list(r.codes) for r in stored.collect()} == {f"k{i:03d}": c.tolist() for i, c in enumerate(codes)}
    decoded = books[np.arange(PARTS), codes].reshape(len(x), -1)
    estimate, norms = ints @ decoded.T, np.linalg.norm(x, axis=1)
    want = {}
    for i in range(len(x)):
        near = sorted(set(range(len(x))) - {i}, key=lambda j: (-estimate[i, j], j))[:20]
        score = {j: np.floor(abs(s) + 0.5) * np.sign(s) / 1e6 for j in near for s in [x[i] @ x[j] / norms[i] / norms[j] * 1e6]}
        want[f"k{i:03d}"] = [f"k{j:03d}" for j in sorted(near, key=lambda j: (-score[j], j))[:5]]
    for budget in (64 << 20, 40 * (8 * DIM + 64)):      # one broadcast, and blocks of queries
        found = Q.pq_search(queries, index, stored, got, k=5, rerank=20, exclude_self=True, max_broadcast_bytes=budget, **NAMES)
        lists = {}
        for r in found.orderBy("query_id", "rank").collect():
            lists.setdefault(r.query_id, []).append(r.link)
        assert lists == want


def test_all_rows_reranked_is_exact_search(spark, data):
    _, index, queries = data
    books = Q.train_books(index, dim=DIM, parts=PARTS, entries=3, rounds=1, **NAMES)
    codes = Q.encode(index, books, **NAMES)
    got = Q.pq_search(queries, index, codes, books, k=7, rerank=1000, **NAMES)
    want = K.knn_search(queries, index, dim=DIM, k=7, **NAMES)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))
    near = Q.pq_candidates(queries, codes, books, 9, index_key="link")
    assert near.groupBy("_q").count().where("count <> 9").count() == 0


def test_empty_sides(spark, data):
    _, index, queries = data
    none = index.where("false")
    books = Q.train_books(none, dim=DIM, parts=PARTS, entries=4, **NAMES)
    assert Q.pq_search(queries, none, Q.encode(none, books, **NAMES), books, k=3, rerank=5, **NAMES).count() == 0
    books = Q.train_books(index, dim=DIM, parts=PARTS, entries=4, **NAMES)
    codes = Q.encode(index, books, **NAMES)
    assert Q.pq_search(queries.where("false"), index, codes, books, k=3, rerank=5, **NAMES).count() == 0
    with pytest.raises(ValueError):
        Q.train_books(index, dim=DIM, parts=3, **NAMES)
