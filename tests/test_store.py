"""The stored tables and the serving paths (exact and inverted file)."""

from pyspark.sql import functions as F

from cadenza.plans import store as PL
from cadenza.session import scratch_path
from cadenza.sources.tables import sentences, songs
from conftest import SF_SMALL


def test_inverted_file_serving_with_every_cell_equals_exact(spark):
    store = PL.build_store(songs(spark, SF_SMALL), scratch_path(spark, "test-store"), dim=64,
                           bucketed=True, ivf_cells=4)
    exact = PL.recommend_from_store(sentences(spark, SF_SMALL), store, dim=64)
    every = PL.recommend_from_store(sentences(spark, SF_SMALL), store, dim=64, nprobe=4)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert exact.columns == every.columns
    assert rows(exact) == rows(every)
    some = PL.recommend_from_store(sentences(spark, SF_SMALL), store, dim=64, nprobe=1).collect()
    by_query = {}
    for r in some:
        by_query.setdefault(r.query_id, []).append(r["rank"])
    assert by_query and all(sorted(v) == list(range(1, len(v) + 1)) for v in by_query.values())


def test_sparse_store_serves_the_same_answers(spark):
    dense = PL.build_store(songs(spark, SF_SMALL), scratch_path(spark, "test-dense"), dim=64)
    sparse = PL.build_store(songs(spark, SF_SMALL), scratch_path(spark, "test-sparse"), dim=64, sparse=True)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    a = PL.recommend_from_store(sentences(spark, SF_SMALL), dense, dim=64)
    b = PL.recommend_from_store(sentences(spark, SF_SMALL), sparse, dim=64)
    assert rows(a) == rows(b) and len(rows(a)) > 0
    stored = spark.read.parquet(sparse.embeddings).schema["emotions_embeddings"].dataType.simpleString()
    assert stored == "struct<indices:array<int>,values:array<float>>"


def test_sparse_index_in_both_search_paths(spark):
    from cadenza.operators.embed import embed
    from cadenza.operators.knn import knn_search
    from cadenza.plans import catalog as C

    lab = C.labeled(spark, SF_SMALL)
    dense, sparse = embed(lab, dim=64), embed(lab, dim=64, sparse=True)
    q = embed(lab, dim=64).select(F.col("link").alias("qk"), F.col("emotions_embeddings").alias("qv"))
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    for opts in ({}, {"max_broadcast_bytes": 20_000}):
        kw = dict(dim=64, k=5, query_key="qk", query_vec="qv", index_key="link", exclude_self=True, **opts)
        assert rows(knn_search(q, dense, **kw)) == rows(knn_search(q, sparse, **kw))


def test_scratch_can_be_dropped(spark, monkeypatch):
    import os

    from cadenza import session

    monkeypatch.setattr(session, "_SCRATCH", [])
    path = scratch_path(spark, "test-drop")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local) and session.drop_scratch(spark) == 1 and not os.path.exists(local)


def test_inverted_file_follows_the_index(spark):
    """Changed, new and deleted songs: the refreshed file holds the rows of a rebuilt one, also after
    a second delta, a retry and a compaction."""
    from cadenza.operators import index as X
    from cadenza.operators import ivf as V

    root = scratch_path(spark, "test-follow")
    rows = [(f"/s/{i}", "a", f"s{i}", "x", [float(i % 7 + 1), float(i % 5), 1.0], 1.0) for i in range(60)]
    schema = "link string, artist string, song string, llm_labeled_emotions string, emotions_embeddings array<float>, norm double"
    kw = dict(dim=3, payload=["artist", "song"])
    index = spark.createDataFrame(rows, schema)
    X.write_version(index, f"{root}/index")
    model = V.hash_pivots(index, "emotions_embeddings", 3, 4, "link")
    path = V.write_cells(index, model, f"{root}/cells", covers=1, **kw)

    def held(of):
        return sorted((r.link, tuple(r.emotions_embeddings), r.cell) for r in of.collect())

    def check(step):
        assert V.refresh_cells(spark, f"{root}/index", model, path, **kw) == max(X.list_versions(spark, f"{root}/index"))
        n = len(X.list_versions(spark, V._versions(path)))
        assert V.refresh_cells(spark, f"{root}/index", model, path, **kw) and len(X.list_versions(spark, V._versions(path))) == n
        V.write_cells(X.read_index(spark, f"{root}/index"), model, f"{root}/rebuilt-{step}", **kw)
        assert held(V.read_cells(spark, path)) == held(V.read_cells(spark, f"{root}/rebuilt-{step}"))

    def change(seq, links, deleted):
        delta = [(link, "a", "new", "x", None if deleted else [1.0, float(seq), 9.0], None if deleted else 1.0) for link in links]
        changed = spark.createDataFrame(delta, schema).selectExpr("*", f"{seq}L AS seq", f"{str(deleted).lower()} AS deleted")
        X.write_version(changed, f"{root}/index", X.DELTA, f"s/{seq}/{deleted}")

    change(2, ["/s/1", "/s/2", "/s/new"], False)
    check("upsert")
    change(3, ["/s/2", "/s/3", "/s/new"], True)
    check("delete")
    live = {r.link for r in V.read_cells(spark, path).collect()}
    assert not live & {"/s/2", "/s/3", "/s/new"} and "/s/1" in live
    change(1, ["/s/3"], False)                               # late: the deletion stands
    check("late")
    X.compact(spark, f"{root}/index")
    X.drop_before(spark, f"{root}/index")
    change(9, ["/s/3"], False)
    check("compacted")
