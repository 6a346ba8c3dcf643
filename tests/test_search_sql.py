"""The table function of SQL against the search of the library."""

import pytest
from pyspark.sql import functions as F

from cadenza.operators import index as X
from cadenza.operators.knn import knn_search
from cadenza.plans import search_sql as Q
from cadenza.sources import index_source as I

DIM, COLUMNS = 4, ("artist", "song", "link", "llm_labeled_emotions", "emotions_embeddings", "norm")


def songs(spark, ids):
    rows = [(f"/{i}", [float((i * p) % 7) for p in (1, 2, 3, 5)]) for i in ids]
    df = spark.createDataFrame(rows, "link string, emotions_embeddings array<float>")
    return X.build_index(df.select(F.lit("a").alias("artist"), "link", F.col("link").alias("song"),
                                   F.lit("joy").alias("llm_labeled_emotions"), "emotions_embeddings"), DIM).select(*COLUMNS)


@pytest.fixture
def base(spark, tmp_path):
    path = str(tmp_path / "index")
    I.write_index(songs(spark, range(60)), path, buckets=3)
    gone = songs(spark, range(5)).withColumn("seq", F.lit(1).cast("bigint")).withColumn("deleted", F.lit(True))
    I.write_index(gone, path, X.DELTA, 3)
    return path


@pytest.fixture
def queries(spark):
    rows = [(f"q{i}", "joy", [float(i % 3), 1.0, float(i % 5), 2.0]) for i in range(20)]
    rows += [("null", None, None), ("short", None, [1.0]), ("zero", None, [0.0] * 4), ("nan", None, [float("nan"), 1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "query_id string, user_emotions string, query_vec array<float>")
    return df.withColumn("query_norm", F.sqrt(F.aggregate("query_vec", F.lit(0.0), lambda a, x: a + x * x)))


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_equals_the_exact_search(spark, base, queries, monkeypatch, block_bytes):
    monkeypatch.setattr(Q, "BLOCK_BYTES", block_bytes)
    exact = knn_search(queries, I.open_index(spark, base), dim=DIM, k=4, query_norm="query_norm", index_norm="norm",
                       payload=["artist", "song", "llm_labeled_emotions"], query_payload=["user_emotions"])
    found = Q.recommend_sql(queries, base, DIM, 4)
    assert sorted(found.collect()) == sorted(exact.select(found.columns).collect()) and found.count() == 80
    assert not {"/0", "/1", "/2", "/3", "/4"} & {r.link for r in found.collect()}
    assert Q.recommend_sql(queries.limit(0), base, DIM, 4).collect() == []


def test_refuses_what_it_cannot_answer(spark, base, queries):
    Q.register(spark)
    for text, message in ((f"search_index(TABLE(SELECT query_id FROM {{q}}), '{base}', 4, 4)", "lack"),
                          (f"search_index(TABLE(SELECT *, 0 AS bucket FROM {{q}}), '{base}', 0, 4)", "constants"),
                          (f"search_index(TABLE(SELECT *, 0 AS bucket, 1 AS link FROM {{q}}), '{base}', 4, 4)", "both sides"),
                          (f"search_index(TABLE(SELECT *, 7 AS bucket FROM {{q}}), '{base}', 4, 4)", "no bucket")):
        with pytest.raises(Exception, match=message):
            spark.sql(f"SELECT * FROM {text}", q=queries).collect()
