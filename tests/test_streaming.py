"""Index refresh by stream: batches, retries, late changes, deletes, and a built index."""

from pyspark.sql import functions as F

from cadenza.operators import index as X
from cadenza.plans import catalog as C
from cadenza.plans import store as PL
from cadenza.session import scratch_path
from cadenza.sources.fixtures import next_snapshot
from cadenza.sources.tables import read_table, songs, songs_from_documents
from cadenza.streaming import index_stream as S
from conftest import SF_SMALL

DIM = 64


def _key(df):
    return sorted((r.link, r.llm_labeled_emotions, r.norm) for r in df.collect())


def _state(spark, rows):
    return spark.createDataFrame(rows, "link string, v string, seq bigint, deleted boolean")


def test_merge_takes_the_largest_seq(spark):
    base = _state(spark, [("a", "old", 1, False), ("b", "old", 5, False), ("c", None, 7, True), ("d", "old", 2, False)])
    changes = _state(spark, [("a", "new", 2, False), ("b", "late", 4, False), ("c", "late", 6, False),
                             ("d", None, 3, True), ("d", "late", 1, False), ("e", "new", 1, False), ("e", "newer", 2, False)])
    got = {r.link: (r.v, r.seq, r.deleted) for r in X.merge(base, changes).collect()}
    assert got == {"a": ("new", 2, False), "b": ("old", 5, False), "c": (None, 7, True), "d": (None, 3, True),
                   "e": ("newer", 2, False)}


def test_stream_continues_a_built_index(spark):
    root = scratch_path(spark, "test-stream")
    store = PL.build_store(songs(spark, SF_SMALL), f"{root}/store", dim=DIM, bucketed=True)
    lex = PL.open_lexicon(spark, store)
    before = X.read_index(spark, store.index).count()
    live = [r.link for r in X.read_index(spark, store.index).limit(3).collect()]
    five = songs(spark, SF_SMALL).where(F.col("link").isin(live))
    S.changes_from_rows(five, seq=1, change=S.DELETE).write.parquet(f"{root}/a")
    assert S.run_index_stream(spark, f"{root}/a", store.index, f"{root}/ckpt-a", lex, DIM).count() == before - 3
    # a new checkpoint (as after a loss) neither overwrites a version nor undoes newer changes
    S.changes_from_rows(five, seq=0).write.parquet(f"{root}/b")
    assert S.run_index_stream(spark, f"{root}/b", store.index, f"{root}/ckpt-b", lex, DIM).count() == before - 3
    S.changes_from_rows(five, seq=2).write.mode("append").parquet(f"{root}/b")
    assert S.run_index_stream(spark, f"{root}/b", store.index, f"{root}/ckpt-b", lex, DIM).count() == before
    assert [m["kind"] for m in X.list_versions(spark, store.index).values()] == ["base", "delta", "delta", "delta"]
    rows = _key(X.read_index(spark, store.index))
    X.compact(spark, store.index, bucket_by="link", buckets=2)
    assert X.drop_before(spark, store.index) == [1, 2, 3, 4]
    assert _key(X.read_index(spark, store.index)) == rows


def test_retried_epoch_rewrites_its_own_version(spark):
    lex = C.lexicon(spark, SF_SMALL)
    base_dir = scratch_path(spark, "test-index")
    rows = S.delta_of(S.changes_from_rows(songs(spark, SF_SMALL), seq=1), lex, DIM)
    assert X.write_version(rows, base_dir, X.DELTA, "stream/0") == 1
    assert X.write_version(rows, base_dir, X.DELTA, "stream/1") == 2
    assert X.write_version(rows, base_dir, X.DELTA, "stream/0") == 1
    assert list(X.list_versions(spark, base_dir)) == [1, 2]
    assert X.read_index(spark, base_dir).count() == rows.where("NOT deleted").count()


def test_rows_that_lose_their_labels_leave_the_index(spark):
    lex = C.lexicon(spark, SF_SMALL)
    base_dir = scratch_path(spark, "test-unlabeled")
    X.write_version(S.delta_of(S.changes_from_rows(songs(spark, SF_SMALL), seq=1), lex, DIM), base_dir, X.DELTA)
    link = X.read_index(spark, base_dir).first().link
    blank = songs(spark, SF_SMALL).where(F.col("link") == link).withColumn("text", F.lit("nothing"))
    X.write_version(S.delta_of(S.changes_from_rows(blank, seq=2), lex, DIM), base_dir, X.DELTA)
    assert link not in {r.link for r in X.read_index(spark, base_dir).collect()}


def test_batch_diff_as_changes(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    lex = C.lexicon(spark, SF_SMALL)
    old, new = songs_from_documents(docs), next_snapshot(docs)
    batch = S.changes_from_diff(new, X.snapshot_diff(old, new), seq=2)
    first = S.delta_of(S.changes_from_rows(old, seq=1), lex, DIM)
    full = S.delta_of(S.changes_from_rows(new, seq=1), lex, DIM)
    got = X.merge(first, S.delta_of(batch, lex, DIM)).where("NOT deleted")
    assert _key(got) == _key(full.where("NOT deleted"))


def test_bucketed_base_joins_without_shuffling_the_index(spark):
    base_dir = scratch_path(spark, "test-bucketed")
    rows = S.delta_of(S.changes_from_rows(songs(spark, SF_SMALL), seq=1), C.lexicon(spark, SF_SMALL), DIM)
    X.write_version(rows, base_dir, bucket_by="link", buckets=4)
    index = X.read_state(spark, base_dir)
    assert sorted(index.columns) == sorted(rows.columns) and index.count() == rows.count()
    keys = spark.createDataFrame([(f"/doc/{i}",) for i in range(50)], "link string")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = index.join(keys, "link", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1      # the keys side only
