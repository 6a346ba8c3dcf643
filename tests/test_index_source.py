"""The index as a data source, against the states written and against ``read_index``."""

import pytest
from pyspark.sql import functions as F

from cadenza.operators import index as X
from cadenza.sources import index_source as I

SCHEMA = "link string, label string, v array<float>, seq bigint, deleted boolean"


def state(spark, *rows):
    return spark.createDataFrame([(k, label, None if label is None else [float(len(label))], seq, label is None)
                                  for k, label, seq in rows], SCHEMA)


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("source") / "index")
    I.write_index(state(spark, ("a", "one", 0), ("b", "two", 0), ("c", "three", 5), ("d", "four", 0), ("ü", "", 0)), path, buckets=4)
    I.write_index(state(spark, ("a", "uno", 1), ("b", None, 1), ("c", "late", 2), ("e", "new", 1), ("d", "four", 1)), path, X.DELTA, 4)
    I.write_index(state(spark, ("a", "eins", 2), ("a", "first", 1), ("b", "zwei", 2), ("e", None, 2), ("f", None, 1)), path, X.DELTA, 4)
    return path


def rows(df):
    return sorted((r.link, r.label, r.v) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reads_the_merged_state_of_every_version(spark, base):
    for version in (1, 2, 3):
        assert rows(I.open_index(spark, base, version=version)) == rows(X.read_index(spark, base, version))
    newest = I.open_index(spark, base)
    assert newest.columns == ["link", "label", "v"]
    assert rows(newest) == [("a", "eins", [4.0]), ("b", "zwei", [4.0]), ("c", "three", [5.0]), ("d", "four", [4.0]), ("ü", "", [0.0])]
    assert I.open_index(spark, base, columns="link").columns == ["link"]


def test_keys_are_pushed_down(spark, base):
    one = I.open_index(spark, base).where("link = 'a'")
    assert rows(one) == [("a", "eins", [4.0])] and one.rdd.getNumPartitions() == 1
    assert "PushedFilters" in plan(one) or "(link = a)" not in plan(one).split("Scan")[0]
    assert rows(I.open_index(spark, base).where(F.col("link").isin("b", "e", "ü"))) == [("b", "zwei", [4.0]), ("ü", "", [0.0])]
    assert rows(I.open_index(spark, base).where("link = 'a' AND link IN ('b', 'c')")) == []
    assert rows(I.open_index(spark, base).where("label = 'three' OR link = 'a'")) == [("a", "eins", [4.0]), ("c", "three", [5.0])]


def test_a_stream_reads_every_version_once(spark, base, tmp_path):
    I.register(spark)
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    I.write_index(state(spark, ("a", "one", 0)), str(tmp_path / "index"), buckets=2)

    def drain(path):
        stream = spark.readStream.format(I.NAME).option("changes", "true").load(path)
        stream.writeStream.format("parquet").option("checkpointLocation", mark).trigger(availableNow=True).start(out).awaitTermination()
        return sorted((r.version, r.link, r.deleted) for r in spark.read.parquet(out).collect())

    path = str(tmp_path / "index")
    assert drain(path) == [(1, "a", False)]
    I.write_index(state(spark, ("a", None, 1), ("b", "two", 1)), path, X.DELTA, 2)
    assert drain(path) == [(1, "a", False), (2, "a", True), (2, "b", False)]
    assert drain(path) == drain(path)


def test_retries_empty_versions_and_refusals(spark, base, tmp_path):
    path = str(tmp_path / "index")
    I.write_index(state(spark, ("a", "one", 0), ("b", "two", 0)), path, buckets=2)
    for label in ("x", "yy"):
        I.write_index(state(spark, ("a", label, 1)), path, X.DELTA, 2, source="job/1")
    assert max(X.list_versions(spark, path)) == 2
    assert rows(I.open_index(spark, path)) == rows(X.read_index(spark, path)) == [("a", "yy", [2.0]), ("b", "two", [3.0])]
    I.write_index(state(spark, ("a", "z", 9)).limit(0), path, X.DELTA, 2)
    assert rows(I.open_index(spark, path)) == [("a", "yy", [2.0]), ("b", "two", [3.0])]
    with pytest.raises(Exception, match="buckets"):
        I.write_index(state(spark, ("a", "z", 9)), path, X.DELTA, 3)
    with pytest.raises(Exception, match="not there"):
        I.open_index(spark, path, version=8).collect()
    with pytest.raises(Exception, match="no index version"):
        I.open_index(spark, str(tmp_path / "none"))
    X.write_version(state(spark, ("q", "other", 0)), path)
    with pytest.raises(Exception, match="same buckets"):
        I.open_index(spark, path).collect()
