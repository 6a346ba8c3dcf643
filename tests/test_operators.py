"""Invariants of the operators on the small test tables."""

from pyspark.sql import functions as F

from cadenza.operators import index as X
from cadenza.operators import label as L
from cadenza.operators import measures as M
from cadenza.plans import catalog as C
from cadenza.sources import files as io
from cadenza.sources.fixtures import next_snapshot
from cadenza.sources.tables import read_table, songs, songs_from_documents, spread
from conftest import SF_SMALL


def test_csv_golden(spark, tmp_path):
    body = ('artist,song,link,text\n'
            'ABBA,"He said ""hi""",/a/1,"line1\nline2, with comma"\n'
            'X,"back\\slash",/a/2,\n'
            'Y,plain,/a/3,"ends with \\"\n'
            'Z,q,/a/4,"ok"\n')
    p = tmp_path / "songs.csv"
    p.write_text(body)
    rows = [tuple(r) for r in io.read_songs_csv(spark, str(p)).orderBy("link").collect()]
    assert rows == [("ABBA", 'He said "hi"', "/a/1", "line1\nline2, with comma"),
                    ("X", "back\\slash", "/a/2", None),
                    ("Y", "plain", "/a/3", "ends with \\"),
                    ("Z", "q", "/a/4", "ok")]


def test_error_rate_golden(spark):
    df = spark.createDataFrame([("ERROR: a",), ("b",), (None,)], "llm_labeled_emotions string")
    r = M.error_rate(df).collect()[0]
    assert (r.n_songs, r.n_errors, r.error_pct) == (3, 1, 33.0)


def test_sample_is_stable_subset(spark):
    s = songs(spark, SF_SMALL)
    a = {r.link for r in M.sample_by_key(s, "link", 0.2).collect()}
    b = {r.link for r in M.sample_by_key(s.repartition(5), "link", 0.2).collect()}
    allk = {r.link for r in s.collect()}
    assert a == b and a <= allk and 0 < len(a) < len(allk)


def test_spread_only_scans_of_few_splits(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert spread(d).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = d.repartition(50)
    assert spread(many) is many


def test_small_sample_fractions(spark):
    df = spark.range(100_000).selectExpr("concat('/x/', id) AS link")
    assert 15 < M.sample_by_key(df, "link", 0.0004).count() < 80
    assert M.sample_by_key(df, "link", 0.9996).count() < 100_000 == M.sample_by_key(df, "link", 1.0).count()


def test_error_rate_of_an_empty_table(spark):
    r = M.error_rate(spark.createDataFrame([], "llm_labeled_emotions string")).first()
    assert tuple(r) == (0, 0, None)


def test_query_ids_do_not_collide(spark):
    from cadenza.sources.tables import sentences_from_conversations

    c = spark.createDataFrame([(1, 1000, "user", "a"), (2, 0, "user", "b"), (1, 2500, "user", "c")],
                              "conv_id bigint, turn int, role string, text string")
    assert sentences_from_conversations(c).select("query_id").distinct().count() == 3


def test_rows_keep_their_own_labels(spark):
    lex = spark.createDataFrame([("happy", 0), ("rainy", 4)], "word string, emotion_id int")
    rows = [("/k", "happy day"), ("/k", "nothing"), (None, "rainy rainy happy"), (None, None)]
    got = L.label_emotions(spark.createDataFrame(rows, "link string, text string"), lex).collect()
    assert [(r.link, r.text) for r in got] == rows
    assert [r.llm_labeled_emotions for r in got] == ["ERROR: joy", "ERROR: ", "ERROR: sadness, joy", "ERROR: "]


def test_no_exchange_carries_text(spark):
    lex = C.lexicon(spark, SF_SMALL)
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    from cadenza.operators.prompts import prompt_grid

    for df in (L.label_emotions(songs_from_documents(base), lex), prompt_grid(songs_from_documents(base), lex)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_labels_are_ten_distinct_or_error(spark):
    lab = C.labeled(spark, SF_SMALL).collect()
    assert len(lab) == 200
    for r in lab:
        v = r.llm_labeled_emotions
        if not v.startswith("ERROR: "):
            items = v.split(", ")
            assert len(items) == 10 and len(set(items)) == 10 and set(items) <= set(L.EMOTIONS)


def test_lexicon_bounded(spark):
    lex = C.lexicon(spark, SF_SMALL)
    assert lex.where('freq > 0').count() == L.LEXICON_SIZE
    assert lex.count() == L.LEXICON_SIZE + len(L.SEED_WORDS)
    assert lex.where(F.length("word") < L.LEXICON_MIN_LEN).count() == 0
    assert lex.select("word").distinct().count() == lex.count()


def test_recommend_invariants(spark):
    res = C.q_recommend(spark, SF_SMALL)
    rows = res.collect()
    assert rows
    by_q = {}
    for r in rows:
        by_q.setdefault(r.query_id, []).append(r)
        assert -1.0 <= r.score <= 1.0
        assert not r.llm_labeled_emotions.startswith("ERROR")
        assert r.user_emotions and "ERROR" not in r.user_emotions
    for q, rs in by_q.items():
        ranks = sorted(r["rank"] for r in rs)
        assert ranks == list(range(1, len(rs) + 1)) and len(rs) <= 10
        ordered = sorted(rs, key=lambda r: r["rank"])
        assert all((a.score, b.link) >= (b.score, a.link) or a.score > b.score
                   for a, b in zip(ordered, ordered[1:]))


def test_knn_exact_no_self_match(spark):
    rows = C.q_knn_exact(spark, SF_SMALL).collect()
    assert rows and all(r.query_id != r.vec_id for r in rows)


def test_diff_and_upsert_idempotent(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    old, new = songs_from_documents(docs), next_snapshot(docs)
    diff = X.snapshot_diff(old, new)
    counts = dict(diff.groupBy("change").count().collect())
    assert counts == {"delete": 10, "update": 10, "insert": 3}
    lex = C.lexicon(spark, SF_SMALL)
    from cadenza.plans.recommend import song_vectors
    old_index = X.build_index(song_vectors(old, lex, dim=64), dim=64)
    fresh = X.build_index(song_vectors(X.changed_rows(new, diff), lex, dim=64), dim=64)
    once = X.upsert(old_index, diff, fresh)
    twice = X.upsert(once, diff, fresh)
    full = X.build_index(song_vectors(new, lex, dim=64), dim=64)
    key = lambda df: sorted((r.link, r.llm_labeled_emotions, r.norm) for r in df.collect())
    assert key(once) == key(twice) == key(full)


def test_latest_version_numeric(spark):
    rows = [("a", "9"), ("a", "10"), ("b", "2"), ("b", "x"), ("c", "123456789012")]
    df = spark.createDataFrame(rows, "name string, version string")
    got = {r[0]: (r[1], r[2]) for r in X.latest_version(df, "name", "version").collect()}
    assert got == {"a": (10, 0), "b": (2, 1), "c": (123456789012, 0)}


def test_vector_check_counts(spark):
    df = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("a", [0.0, 1.0]), ("b", None), ("c", [1.0]), ("d", [0.0, 0.0]), ("e", [float("nan"), 1.0]), ("f", [1.0, float("inf")])],
        "link string, v array<float>")
    r = X.vector_check(df, 2, vec="v", label=None).collect()[0]
    assert (r.n_rows, r.n_null_vector, r.n_wrong_dim, r.n_zero_norm, r.n_not_finite, r.n_duplicate_key) == (7, 1, 1, 1, 2, 1)
    assert {x.link for x in X.build_index(df, 2, vec="v").collect()} == {"a"}


def test_diff_with_duplicate_keys(spark):
    old = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), ("c", "w")], "link string, text string")
    new = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", "z"), ("b", "z"), ("d", "v")], "link string, text string")
    got = dict(X.snapshot_diff(old, new).collect())
    assert got == {"b": "update", "c": "delete", "d": "insert"}


def test_cluster_conf_sizes_from_the_largest_shuffle():
    from cadenza.session import cluster_conf

    big = cluster_conf(100 * 10**12, 8000)
    assert big["spark.sql.shuffle.partitions"] == "16000"          # twice the cores wins
    assert cluster_conf(100 * 10**12, 100)["spark.sql.shuffle.partitions"] == str(-(-2 * 10**12 // (256 << 20)))
    assert big["spark.sql.adaptive.enabled"] == "true"


def test_scans_read_only_needed_columns_and_take_the_filters(spark):
    from cadenza.plans import catalog as C

    def scans(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [ln for ln in plan.splitlines() if "FileScan" in ln]

    lex = scans(L.build_lexicon(read_table(spark, SF_SMALL, "documents")))
    assert lex and all("ReadSchema: struct<text:string>" in s for s in lex)
    flags = [s for s in scans(C.q_exclude_flagged(spark, SF_SMALL)) if "toxic" in s]
    assert flags and "EqualTo(toxic,1)" in flags[0] and "quality" not in flags[0]
    knn = scans(C.q_knn_exact(spark, SF_SMALL))
    assert knn and all("label" not in s.split("ReadSchema")[1] for s in knn)
