"""Phrases found by the automaton and by the join, against a plain search."""

import re

import pytest
from pyspark.sql import functions as F

from cadenza.operators.phrase_tags import phrase_tag, word_sequences

TEXTS = ["", None, "Silent night, holy night", "silent nights", "a b a b a", "night", "¿Holy\nNIGHT! holy night", "b" * 50_000,
         "holy " * 20_000 + "moly"]
PHRASES = ["silent night", "holy night", "night holy", "a b a", "b a", "Night", "holy... night", "", None, "!?", "holy holy moly", "b" * 50_000]


def plain(text):
    words = f" {' '.join(re.findall('[a-z]+', (text or '').lower()))} "
    wanted = {" ".join(re.findall("[a-z]+", (p or "").lower())) for p in PHRASES} - {""}
    return sorted(p for p in wanted if f" {p} " in words)


@pytest.mark.parametrize("max_bytes", [1 << 20, 10])
def test_both_ways_equal_a_plain_search(spark, max_bytes):
    docs = spark.createDataFrame([(str(i), t, "x") for i, t in enumerate(TEXTS)], "link string, text string, phrases string").repartition(3)
    listed = spark.createDataFrame([(p,) for p in PHRASES + PHRASES], "phrase string")
    got = {r.link: r.phrases for r in phrase_tag(docs, listed, max_bytes=max_bytes).collect()}
    assert got == {str(i): plain(t) for i, t in enumerate(TEXTS)}
    assert got["4"] == ["a b a", "b a"]


@pytest.mark.parametrize("max_bytes", [1 << 20, -1])
def test_empty_lists_and_tables(spark, max_bytes):
    docs = spark.createDataFrame([("1", "a b")], "link string, text string")
    none = spark.createDataFrame([], "phrase string")
    one = spark.createDataFrame([("a b",)], "phrase string")
    assert [r.phrases for r in phrase_tag(docs, none, max_bytes=max_bytes).collect()] == [[]]
    assert phrase_tag(docs.limit(0), one, max_bytes=max_bytes).collect() == []


def test_the_automaton_is_map_only(spark):
    docs = spark.range(100).select(F.col("id").cast("string").alias("link"), F.lit("a b c").alias("text"))
    one = spark.createDataFrame([("a b",)], "phrase string")
    assert "Exchange" not in phrase_tag(docs, one)._jdf.queryExecution().executedPlan().toString()


def test_word_sequences(spark):
    words = spark.createDataFrame([(1, ["a", "b", "a", "b"]), (2, ["a"]), (3, []), (4, None)], "k int, w array<string>")
    assert sorted(tuple(r) for r in word_sequences(words, "w", (1, 3)).collect()) == [
        (1, "a"), (1, "a b a"), (1, "b"), (1, "b a b"), (2, "a")]
