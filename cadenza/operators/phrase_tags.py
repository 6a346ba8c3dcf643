"""Many multi-word phrases found in one pass over the texts (M9).

A phrase stands in a text where its words (runs of ``a``-``z`` of the lower-cased text) follow one another;
overlapping and nested phrases all count. :func:`phrase_tag` has two ways with the same result:

* a phrase list within ``max_bytes`` (summed by Spark before anything is fetched) is shipped as one text,
  and every task builds an Aho-Corasick automaton from it once and runs each text through it: map-only,
  time grows with the text and the hits, not with the number of phrases;
* a longer list is joined: the word sequences of the lengths that occur in the list, distinct per row,
  meet the phrases by a shuffle join, so no list is too long.

Phrases without a word and null phrases are found nowhere; repeated ones count once. A null or wordless
text has the empty array.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.vectors import tokens

MAX_BYTES = 16 << 20


def word_sequences(df: DataFrame, words: str, lengths: Sequence[int], out: str = "phrase") -> DataFrame:
    """A row per run of ``n`` neighbouring entries of ``words`` for every ``n`` in ``lengths``, joined by a
    space in column ``out``; the other columns of ``df`` go along."""
    w, none = F.col(words), F.array().cast("array<string>")

    def runs(n: int):
        starts = F.sequence(F.lit(1), F.size(w) - (n - 1))
        return F.when(F.size(w) >= n, F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(none)

    rest = [c for c in df.columns if c != words]
    return df.select(*rest, F.explode(F.array_distinct(F.concat(none, *[runs(n) for n in lengths]))).alias(out))


def _normal(text: str):
    return F.array_join(tokens(F.col(text)), " ")


def _automaton(phrases: Sequence[str]):
    """Finds `` phrase `` in `` words of a text ``; hits may share the space between them."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for p in phrases:
        found.add_word(f" {p} ", p)
    if len(found):
        found.make_automaton()
    return found


def find_phrases(phrases: Sequence[str]):
    """Normalised text to the array of its phrases, distinct and sorted."""
    packed = "\n".join(phrases)         # words hold no line feed: one string pickles at once

    @F.pandas_udf("array<string>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = _automaton(packed.split("\n") if packed else [])
        for texts in batches:
            yield pd.Series([sorted({p for _, p in automaton.iter(f" {t} ")}) if t and len(automaton) else []
                             for t in texts], dtype=object)

    return find


def phrase_tag(df: DataFrame, phrases: DataFrame, phrase: str = "phrase", text: str = "text", key: str = "link",
               out: str = "phrases", max_bytes: int = MAX_BYTES) -> DataFrame:
    """``df`` with its phrases, distinct and sorted, in ``out``. ``key`` is used by the join only: rows of
    one key share their texts' phrases there, so it must tell rows apart, and rows of a null key have none."""
    wanted = phrases.select(_normal(phrase).alias("_p")).where("_p <> ''").distinct()
    size = wanted.agg(F.coalesce(F.sum(F.octet_length("_p") + 1), F.lit(0))).first()[0]
    if size <= max_bytes:
        find = find_phrases([r[0] for r in wanted.collect()])
        return df.withColumn(out, find(F.coalesce(_normal(text), F.lit(""))))
    lengths = sorted(r[0] for r in wanted.select(F.size(F.split("_p", " "))).distinct().collect())
    runs = word_sequences(df.select(F.col(key).alias("_k"), tokens(F.col(text)).alias("_w")), "_w", lengths, "_p")
    hits = runs.join(wanted, "_p").groupBy("_k").agg(F.array_sort(F.collect_set("_p")).alias(out))
    return (df.drop(out).join(hits, F.col(key) == F.col("_k"), "left").drop("_k")
            .withColumn(out, F.coalesce(out, F.array().cast("array<string>"))))
