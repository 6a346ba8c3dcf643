"""Reads between and as of versions of the index, against the states written."""

import pytest
from pyspark.sql import functions as F

from cadenza.operators import index as X

SCHEMA = "link string, label string, v array<float>, seq bigint, deleted boolean"


def state(spark, *rows):
    return spark.createDataFrame([(k, label, None if label is None else [float(len(label))], seq, label is None)
                                  for k, label, seq in rows], SCHEMA)


def feed(spark, base, after, until):
    return sorted((r.link, r.change, r.label) for r in X.read_changes(spark, base, after, until).collect())


@pytest.fixture
def base(spark, tmp_path):
    path = str(tmp_path / "index")
    X.write_version(state(spark, ("a", "one", 0), ("b", "two", 0), ("c", "three", 5), ("d", "four", 0)), path)
    X.write_version(state(spark, ("a", "uno", 1), ("b", None, 1), ("c", "late", 2), ("e", "new", 1), ("d", "four", 1)), path, X.DELTA)
    X.compact(spark, path)
    X.write_version(state(spark, ("a", "one", 2), ("b", "zwei", 2), ("e", None, 2), ("f", None, 1), ("f", None, 1)), path, X.DELTA)
    return path


def test_changes_are_net_and_carry_images(spark, base):
    # the change to c is late, that of d changes nothing, f was never there
    assert feed(spark, base, 1, 2) == [("a", "update_postimage", "uno"), ("a", "update_preimage", "one"),
                                       ("b", "delete", "two"), ("e", "insert", "new")]
    assert feed(spark, base, 2, 3) == feed(spark, base, 4, 4) == []
    assert feed(spark, base, 3, 4) == feed(spark, base, 2, 4)
    assert feed(spark, base, 1, 4) == [("b", "update_postimage", "zwei"), ("b", "update_preimage", "two")]


def test_as_of_a_version(spark, base):
    read = lambda v: sorted((r.link, r.label) for r in X.read_index(spark, base, v).collect())
    assert read(1) == [("a", "one"), ("b", "two"), ("c", "three"), ("d", "four")]
    assert read(2) == read(3) == [("a", "uno"), ("c", "three"), ("d", "four"), ("e", "new")]
    assert read(4) == read(None) == [("a", "one"), ("b", "zwei"), ("c", "three"), ("d", "four")]


def test_a_replaced_base_is_compared_whole(spark, base):
    X.write_version(state(spark, ("a", "one", 3), ("g", "other", 3)), base)
    assert feed(spark, base, 4, 5) == [("b", "delete", "zwei"), ("c", "delete", "three"), ("d", "delete", "four"),
                                       ("g", "insert", "other")]


def test_versions_that_are_gone_raise(spark, base):
    X.drop_before(spark, base)
    assert X.read_index(spark, base, 3).count() == 4
    for after, until in ((1, 4), (4, 3), (3, 9)):
        with pytest.raises(ValueError):
            X.read_changes(spark, base, after, until)
