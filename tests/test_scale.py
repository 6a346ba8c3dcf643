"""Searches that grow with the input, not with its square or with a batch of any size: rows built here."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadenza.operators import knn as K
from cadenza.operators import label as L
from cadenza.operators import pq as Q
from cadenza.plans import recommend as R
from cadenza.plans import search_sql as S
from cadenza.session import scratch_path
from cadenza.sources import index_source as I

DIM = 16


@pytest.fixture(scope="module")
def repeated(spark):
    """300 rows of 9 vectors, 90 queries of 7 vectors."""
    rng = np.random.default_rng(3)
    base = rng.integers(-2, 3, size=(9, DIM)).astype(float)
    base[:, 0] += 5.0
    rows = [(f"k{i:03d}", [float(v) for v in base[i % 9]], f"p{i}") for i in range(300)]
    asked = [(f"q{i:03d}", [float(v) for v in base[i % 7]]) for i in range(90)]
    return (spark.createDataFrame(rows, "link string, v array<float>, name string").repartition(4),
            spark.createDataFrame(asked, "qid string, qv array<float>"))


def search(queries, index, **options):
    found = K.knn_search(queries, index, dim=DIM, k=6, query_key="qid", query_vec="qv", index_key="link", index_vec="v",
                         payload=["name"], **options)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_equal_vectors_meet_the_queries_once(spark, repeated, metric):
    index, queries = repeated
    whole = search(queries, index, metric=metric)
    assert len(whole) == 90 * 6
    assert search(queries, index, metric=metric, few_vectors=True) == whole
    # too large for the broadcast: the scan of the index answers
    assert search(queries, index, metric=metric, few_vectors=True, max_broadcast_bytes=600) == whole


def test_few_vectors_are_what_is_broadcast(spark, repeated, monkeypatch):
    index, queries = repeated
    sent, real = [], K._score_queries
    monkeypatch.setattr(K, "_score_queries", lambda q, local, *a: sent.append(local) or real(q, local, *a))
    search(queries, index, few_vectors=True)
    assert sent[0].num_rows == 9 and all(len(r) == 6 for r in sent[0]["_rows"].to_pylist())


def test_distances_that_round_alike_go_by_key(spark):
    # the second row is farther by less than the rounding, but its key is smaller
    index = spark.createDataFrame([("b", [1.0]), ("a", [1.0000002]), ("c", [9.0])], "link string, v array<double>").coalesce(1)
    asked = spark.createDataFrame([("q", [0.0])], "qid string, qv array<double>")
    found = K.knn_search(asked, index, dim=1, k=1, query_key="qid", query_vec="qv", index_key="link", index_vec="v", metric="l2")
    assert [(r["link"], r["score"]) for r in found.collect()] == [("a", -1.0)]


def test_kernel_with_a_floor_keeps_the_answers():
    rng = np.random.default_rng(5)
    X, asked = rng.normal(size=(900, DIM)), rng.normal(size=(40, DIM))
    xn, qn = np.linalg.norm(X, axis=1), np.linalg.norm(asked, axis=1)
    keys = pa.array([f"{i:04d}" for i in range(900)])
    for metric in ("cosine", "dot", "l2"):
        whole = K._score_block(asked, qn, None, X, xn, keys, 10, 6, metric, False)
        best = K._Best(40, 10)
        for lo in range(0, 900, 300):
            part = slice(lo, lo + 300)
            own = keys.slice(lo, 300)
            best.add(*K._score_block(asked, qn, None, X[part], xn[part], own, 10, 6, metric, False, best.floor), {"_ik": own})
        found = best.table()
        assert found["_q"].to_pylist() == whole[0].tolist()
        assert found["_ik"].to_pylist() == [f"{i:04d}" for i in whole[1]]
        assert found["score"].to_pylist() == whole[2].tolist()


def test_packed_vectors_come_back():
    m = np.zeros((4, DIM))
    m[1, 3], m[2] = -2.5, np.arange(DIM) + 1.0
    packed = K._packed(m)
    assert (K._unpacked(packed, DIM) == m).all() and packed[0] == packed[3] != packed[1]


def test_sql_deals_every_distinct_vector_once(spark, repeated, monkeypatch):
    index, queries = repeated
    base = scratch_path(spark, "sql-few")
    I.write_index(index.select(F.lit("a").alias("artist"), F.col("name").alias("song"), "link", F.lit("joy").alias("llm_labeled_emotions"),
                               F.col("v").alias("emotions_embeddings"), K.norm("v").alias("norm")), base)
    asked = queries.select(F.col("qid").alias("query_id"), F.lit("joy").alias("user_emotions"), F.col("qv").alias("query_vec"),
                           K.norm("qv").alias("query_norm"))
    dealt, real = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **kw: dealt.append(kw.get("queries")) or real(self, text, *a, **kw))
    found = S.recommend_sql(asked, base, DIM, 6)
    assert [d.count() for d in dealt if d is not None] == [7]
    whole = R.knn_search(queries, index, dim=DIM, k=6, query_key="qid", query_vec="qv", index_key="link", index_vec="v")
    assert (sorted(tuple(r) for r in found.select("query_id", "rank", "link", "score").collect())
            == sorted(tuple(r) for r in whole.select("qid", "rank", "link", "score").collect()))


def test_codes_are_sent_to_the_queries_if_they_fit(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(120, 8))
    index = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "link int, emotions_embeddings array<double>")
    queries = index.select(F.col("link").alias("query_id"), F.col("emotions_embeddings").alias("query_vec"))
    books = Q.train_books(index, dim=8, parts=4, entries=16, rounds=2)
    codes = Q.encode(index, books)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    sent = Q.pq_candidates(queries, codes, books, 9, exclude_self=True)
    assert "Window" not in sent._jdf.queryExecution().toString()       # a query's rows come from one task
    held = Q._estimate(K_table(queries), codes, books, 9, "link", True, None)
    assert rows(sent) == rows(held) and sent.count() == 120 * 9


def K_table(queries):
    return K._valid_rows(Q._queries(queries, "query_id", "query_vec").toArrow(), "_qv", "_qn", 8, "cosine")


def test_labels_go_to_python_in_batches_of_bounded_bytes(spark):
    keys = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before = [spark.conf.get(k) for k in keys]
    try:
        for k, v in zip(keys, ("2147483647", "10000000")):
            spark.conf.set(k, v)
        lex = L.materialize_lexicon(L.build_lexicon(spark.createDataFrame([("some words here",)], "text string")))
        L.label_emotions(spark.createDataFrame([("love and words",)], "text string"), lex).collect()
        assert int(spark.conf.get(keys[0])) <= 64 << 20 and int(spark.conf.get(keys[1])) <= 10_000
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)


def test_queries_beyond_a_broadcast_are_all_answered(spark):
    """Vectors of floats: half as many bytes as the doubles that the broadcast's rows are counted by."""
    from cadenza.operators import ivf as V

    rng = np.random.default_rng(11)
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(rng.normal(size=(240, 64)))] + [(900, None), (901, [0.0] * 64)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    q = e.selectExpr("vec_id AS query_id", "embedding AS query_vec", "concat('n', vec_id) AS note")
    model = V.hash_pivots(e, "embedding", 64, 4, "vec_id")
    path = V.write_cells(e, model, scratch_path(spark, "test-all-cells"), dim=64, index_key="vec_id", index_vec="embedding")
    kw = dict(dim=64, k=5, query_key="query_id", query_vec="query_vec", index_key="vec_id", index_vec="embedding", exclude_self=True,
              query_payload=["note"])
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    exact = rows(K.knn_search(q, e, **kw))
    got, share = V.ivf_search_stored(q, path, model, nprobe=4, max_broadcast_bytes=60 * (8 * 64 + 64), **kw)
    assert rows(got) == exact and len(exact) == 240 * 5 and share == 1.0
    whole, one = V.ivf_search_stored(q, path, model, nprobe=2, **kw)
    cut, two = V.ivf_search_stored(q, path, model, nprobe=2, max_broadcast_bytes=60 * (8 * 64 + 64), **kw)
    assert rows(cut) == rows(whole) and one == two < 1.0


def test_candidates_of_codes_are_not_broadcast_by_the_driver(spark):
    rng = np.random.default_rng(9)
    index = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(rng.normal(size=(150, 8)))],
                                  "link int, emotions_embeddings array<double>")
    queries = index.select(F.col("link").alias("query_id"), F.col("emotions_embeddings").alias("query_vec"))
    books = Q.train_books(index, dim=8, parts=4, entries=16, rounds=2)
    codes = Q.encode(index, books)
    whole = Q.pq_search(queries, index, codes, books, k=5, rerank=20)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "BroadcastExchange" not in plan
    # blocks of queries, without and with all codes in a broadcast
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert len(rows(whole)) == 150 * 5
    for budget in (50 * 128, 110 * 128):
        assert rows(Q.pq_search(queries, index, codes, books, k=5, rerank=20, max_broadcast_bytes=budget)) == rows(whole)


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_products_in_single_precision_lose_no_answer(metric, monkeypatch):
    rng = np.random.default_rng(17)
    plain = rng.normal(size=(700, DIM))
    near = 1000.0 + plain * 1e-3                                     # alike but for a little
    steps = np.repeat(plain[:70], 10, axis=0) + rng.normal(size=(700, DIM)) * 1e-7
    wide, far = (140, 20) if metric == "cosine" else (1, 1)
    kinds = [plain, plain * 10.0 ** wide, plain * 10.0 ** -wide, plain * 10.0 ** rng.integers(-far, far, size=(700, 1)), near, steps,
             np.floor(plain * 4096), plain.round(0)]
    keys, usable = pa.array(np.arange(700)), K._Single.__init__
    for X in kinds:
        X = X[(X != 0).any(axis=1)]
        asked = np.concatenate((X[:60], X[:1] * 0 if metric != "cosine" else X[:1]))
        xn, qn = (np.linalg.norm(m / abs(m).max(), axis=1) * abs(m).max() + (m == 0).all(axis=1) for m in (X, asked))
        args = (asked, qn, np.arange(len(asked)), X, xn, keys.slice(0, len(X)), 10, 6, metric, True)
        got = K._score_block(*args)
        with monkeypatch.context() as m:                             # all in double
            m.setattr(K._Single, "__init__", lambda self, *a: setattr(self, "usable", False))
            want = K._score_block(*args)
        assert K._Single.__init__ is usable and len(got[0]) >= 600
        for a, b in zip(got, want):
            assert a.tolist() == b.tolist()


def test_pairs_are_not_multiplied_in_double(monkeypatch):
    rng = np.random.default_rng(18)
    X = rng.normal(size=(4000, 64))
    n = np.linalg.norm(X, axis=1)
    monkeypatch.setattr(K, "_near", None)
    scored, real = [], K._scaled_round
    monkeypatch.setattr(K, "_scaled_round", lambda s, digits: scored.append(len(s)) or real(s, digits))
    for metric in ("cosine", "dot", "l2"):
        found = K._score_block(X[:300], n[:300], np.arange(300), X, n, pa.array(np.arange(4000)), 10, 6, metric, True)
        assert len(found[0]) == 3000
    assert sum(scored) < 3 * 300 * 4000 // 50
