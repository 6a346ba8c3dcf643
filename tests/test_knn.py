"""The top-k kernel against brute force, on data with many exact ties."""

import numpy as np
from pyspark.sql import functions as F
import pytest

from cadenza.operators import knn as K


def brute(Q, qk, X, xk, k, exclude_self=False):
    out = []
    for i in range(len(Q)):
        rows = []
        for j in range(len(X)):
            if exclude_self and qk[i] == xk[j]:
                continue
            s = Q[i] @ X[j] / (np.linalg.norm(Q[i]) * np.linalg.norm(X[j]))
            y = s * 1e6
            rows.append((-(np.sign(y) * np.floor(abs(y) + 0.5)), xk[j]))
        rows.sort()
        out += [(qk[i], key, -s / 1e6) for s, key in rows[:k]]
    return out


def to_rows(df):
    return [(r[0], r[2], r[3]) for r in df.orderBy("query_id", "rank").collect()]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(-2, 3, size=(12, 8)).astype(float)
    X = base[rng.integers(0, 12, size=150)]       # many exact copies -> ties
    X[X.sum(axis=1) == 0, 0] = 1.0
    xk = [f"k{i:03d}" for i in range(len(X))]
    Q = X[:40]
    qk = xk[:40]
    idx = spark.createDataFrame([(k, [float(v) for v in x]) for k, x in zip(xk, X)], "link string, v array<float>")
    qs = spark.createDataFrame([(k, [float(v) for v in x]) for k, x in zip(qk, Q)], "qid string, qv array<float>")
    return Q, qk, X, xk, idx, qs


@pytest.mark.parametrize("mode", ["broadcast", "block"])
@pytest.mark.parametrize("exclude_self", [False, True])
def test_knn_matches_brute_force(spark, data, mode, exclude_self):
    Q, qk, X, xk, idx, qs = data
    opts = {} if mode == "broadcast" else {"max_broadcast_bytes": 900}
    df = K.knn_search(qs, idx.repartition(3), dim=8, k=5, query_key="qid", query_vec="qv", index_key="link",
                      index_vec="v", exclude_self=exclude_self, **opts).withColumnRenamed("qid", "query_id")
    got = to_rows(df)
    want = brute(Q, qk, X, xk, 5, exclude_self)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([c for *_, c in got], [c for *_, c in want])
    ranks = df.groupBy("query_id").agg({"rank": "max"}).collect()
    assert all(r[1] == 5 for r in ranks)


def test_topk_rows_ties_by_key():
    si = np.array([[5, 7, 7, 7, 1]], dtype=np.int64)
    rank = np.array([4, 3, 0, 2, 1])
    qi, xi = K._topk_rows(si, rank, 2, None)
    assert xi.tolist() == [2, 3]


def test_knn_single_matches_brute(spark, data):
    Q, qk, X, xk, idx, qs = data
    q = [1.0, 0.5, -1.0, 0.0, 2.0, 0.0, 1.0, -0.5]
    got = [(r["link"], r["score"]) for r in K.knn_single(idx, q, k=6, index_key="link", index_vec="v").orderBy("rank").collect()]
    want = brute(np.array([q]), ["q"], X, xk, 6)
    assert [g[0] for g in got] == [w[1] for w in want]


@pytest.mark.parametrize("mode", ["broadcast", "block"])
def test_knn_l2_matches_brute_force(spark, data, mode):
    Q, qk, X, xk, idx, qs = data
    opts = {} if mode == "broadcast" else {"max_broadcast_bytes": 900}
    df = K.knn_search(qs, idx, dim=8, k=4, query_key="qid", query_vec="qv", index_key="link",
                      index_vec="v", metric="l2", **opts).withColumnRenamed("qid", "query_id")
    got = [(a, b) for a, b, _ in to_rows(df)]
    want = []
    for i in range(len(Q)):
        rows = sorted((round(float(np.linalg.norm(Q[i] - X[j])), 6), xk[j]) for j in range(len(X)))
        want += [(qk[i], key) for _, key in rows[:4]]
    assert got == want


def test_ivf_probing_all_cells_is_exact(spark):
    from cadenza.operators import ivf as V
    from cadenza.plans import catalog as C
    from cadenza.sources.tables import read_table
    from conftest import SF_SMALL

    e = read_table(spark, SF_SMALL, "embeddings")
    model = V.train_cells(e, "embedding", 64, 4, seed=1)
    approx, share = V.ivf_search(C.embedding_queries(e), e, model, dim=64, k=10, nprobe=4,
                                 query_key="query_id", query_vec="query_vec", index_key="vec_id",
                                 index_vec="embedding", exclude_self=True)
    exact = C.q_knn_exact(spark, SF_SMALL)
    assert share == 1.0
    rows = lambda df: sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())
    assert rows(approx) == rows(exact)
    assert V.ivf_recall(exact, approx, "query_id", "vec_id").collect()[0]["recall"] == 1.0


def test_stored_norm_is_vector_norm(spark):
    from cadenza.plans import catalog as C
    from conftest import SF_SMALL

    for r in C.vectors(spark, SF_SMALL).collect():
        assert abs(r.norm - float(np.linalg.norm(np.asarray(r.emotions_embeddings, dtype=float)))) < 1e-9
        assert len(r.emotions_embeddings) == C.DIM


def test_ivf_stored_cells_equal_on_the_fly(spark):
    from cadenza.operators import ivf as V
    from cadenza.plans import catalog as C
    from cadenza.session import scratch_path
    from cadenza.sources.tables import read_table
    from conftest import SF_SMALL

    e = read_table(spark, SF_SMALL, "embeddings")
    model = V.train_cells(e, "embedding", 64, 8, seed=3)
    path = V.write_cells(e, model, scratch_path(spark, "test-cells"), dim=64, index_key="vec_id", index_vec="embedding")
    opts = dict(dim=64, k=10, nprobe=2, query_key="query_id", query_vec="query_vec", index_key="vec_id",
                index_vec="embedding", exclude_self=True)
    a, sa = V.ivf_search(C.embedding_queries(e), e, model, **opts)
    b, sb = V.ivf_search_stored(C.embedding_queries(e), path, model, **opts)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(a) == rows(b) and sa == sb
    pruned = spark.read.parquet(path).where(F.col("cell").isin([0, 1]))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "cell" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


def test_bad_rows_take_no_place(spark):
    """One row of NaN or infinity, first in its batch, displaces nobody."""
    good = [(f"k{i}", [float(i), 1.0]) for i in range(1, 6)]
    bad = [("a", [float("nan"), 1.0]), ("b", [float("inf"), 1.0]), ("c", [float("-inf"), float("nan")]), ("d", None),
           ("e", [1.0]), ("f", [None, 1.0])]
    idx = spark.createDataFrame(bad + good, "link string, v array<double>").coalesce(1)
    qs = spark.createDataFrame([("q", [1.0, 1.0]), ("bad", [float("nan"), 0.0])], "qid string, qv array<double>")
    for metric in ("cosine", "dot", "l2"):
        got = K.knn_search(qs, idx, dim=2, k=5, query_key="qid", query_vec="qv", index_key="link", index_vec="v", metric=metric)
        assert {(r.qid, r.link) for r in got.collect()} == {("q", k) for k, _ in good}


def test_l2_does_not_cancel(spark):
    rng = np.random.default_rng(3)
    X = 1000 + rng.normal(size=(80, 64))
    idx = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "link bigint, v array<double>")
    qs = idx.select(F.col("link").alias("qid"), F.col("v").alias("qv"))
    got = K.knn_search(qs, idx, dim=64, k=3, query_key="qid", query_vec="qv", index_key="link", index_vec="v", metric="l2")
    for r in got.collect():
        assert abs(r.score + np.linalg.norm(X[r.qid] - X[r.link])) <= 1e-6
        assert r["rank"] != 1 or (r.link == r.qid and r.score == 0.0)


def test_wide_scores_are_sorted_exactly():
    rng = np.random.default_rng(1)
    si = rng.integers(-(1 << 62), 1 << 62, size=(6, 40))
    si[:, 5] = si[:, 7]
    rank = rng.permutation(40)
    mask = rng.random((6, 40)) < 0.3
    qi, xi = K._topk_rows(si, rank, 4, mask)
    for r in range(6):
        want = sorted((c for c in range(40) if not mask[r, c]), key=lambda c: (-int(si[r, c]), rank[c]))[:4]
        assert xi[qi == r].tolist() == want


def test_ivf_share_and_bad_rows(spark):
    from cadenza.operators import ivf as V
    from cadenza.session import scratch_path

    rng = np.random.default_rng(5)
    rows = [(i, x.tolist()) for i, x in enumerate(rng.normal(size=(200, 8)))]
    rows += [(900, [0.0] * 8), (901, None), (902, [1.0]), (903, [float("nan")] * 8)]
    idx = spark.createDataFrame(rows, "link bigint, v array<double>")
    model = V.hash_pivots(idx, "v", 8, 4, "link")
    path = V.write_cells(idx, model, scratch_path(spark, "test-share"), dim=8, index_key="link", index_vec="v")
    one = idx.where("link = 3").select(F.col("link").alias("qid"), F.col("v").alias("qv"))
    opts = dict(dim=8, k=3, nprobe=1, query_key="qid", query_vec="qv", index_key="link", index_vec="v")
    stored, s1 = V.ivf_search_stored(one, path, model, **opts)
    fly, s2 = V.ivf_search(one, idx, model, **opts)
    assert s1 == s2 < 1.0 and sorted(stored.collect()) == sorted(fly.collect())
    assert spark.read.parquet(path).count() == 200


def test_pruned_search_skips_and_is_exact(spark):
    """Well separated groups, ties and copies: fewer pairs are scored, the answers are exact."""
    import random

    from cadenza.operators import ivf as V
    from cadenza.session import scratch_path

    rng = random.Random(4)
    centre = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in centre[i % 6]]) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(15)] + [(400, None), (401, [0.0] * 8), (402, [float("nan")] * 8)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    q = e.selectExpr("vec_id AS query_id", "embedding AS query_vec")
    model = V.hash_pivots(e, "embedding", 8, 12, "vec_id")
    path = V.write_cells(e, model, scratch_path(spark, "test-pruned"), dim=8, index_key="vec_id", index_vec="embedding")
    kw = dict(dim=8, k=10, query_key="query_id", query_vec="query_vec", index_key="vec_id", index_vec="embedding", exclude_self=True)
    got, share = V.pruned_search(q, path, model, first=1, **kw)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(got) == rows(K.knn_search(q, e, **kw)) and 0 < share < 0.6
