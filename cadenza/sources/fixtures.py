"""Inputs derived from the test tables for steps whose real input we do not have.

* model answers for the cleaners (the hosted model is not available),
* a second snapshot of the songs for the change feed,
* songs with null texts.

All are plain projections of whole tables (whole texts, no row caps).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.vectors import tokens
from cadenza.sources.tables import songs_from_documents


def answer_words(text: str = "text", key: str = "doc_id") -> F.Column:
    """Eight to fourteen words (by ``key % 7``) for a fake answer: the first distinct tokens of the
    whole text in alphabetical order, joined by ', '. The cleaners' bounds lie in that range."""
    n = (F.lit(8) + F.col(key) % 7).cast("int")
    return F.array_join(F.slice(F.array_sort(F.array_distinct(tokens(F.col(text)))), F.lit(1), n), ", ")


def model_answers(documents: DataFrame) -> DataFrame:
    """``(doc_id, answer)``: five shapes of model answers, chosen by ``doc_id % 5``:
    prompt echo then an array, prose then a quoted array, plain text, a broken array over
    two lines, and a code-fence word before the list."""
    w = answer_words()
    shape = F.col("doc_id") % 5
    answer = (F.when(shape == 0, F.concat(F.lit("[INST] label the "), F.col("lang"),
                                          F.lit(" text [/INST] ["), w, F.lit("]")))
              .when(shape == 1, F.concat(F.lit('Sure: ["'), w, F.lit('"]')))
              .when(shape == 2, F.col("text"))
              .when(shape == 3, F.concat(F.lit("["), w, F.lit("\n][x]")))
              .otherwise(F.concat(F.lit("json\n"), w)))
    return documents.select("doc_id", answer.alias("answer"))


def songs_with_nulls(documents: DataFrame) -> DataFrame:
    """Songs whose text is null for every seventh document, to exercise null handling."""
    docs = documents.withColumn("text", F.when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.col("text")))
    return songs_from_documents(docs)


def next_snapshot(documents: DataFrame) -> DataFrame:
    """A later snapshot of the songs: documents 0-9 gone, 10-19 with revised text, and three
    new keys (copies of documents 0-2 under new links)."""
    kept = documents.where(F.col("doc_id") >= 10).withColumn(
        "text", F.when(F.col("doc_id") < 20, F.concat(F.col("text"), F.lit(" revised"))).otherwise(F.col("text")))
    added = documents.where(F.col("doc_id") < 3).select(
        F.col("source").alias("artist"),
        F.concat(F.lit("doc-new-"), F.col("doc_id").cast("string")).alias("song"),
        F.concat(F.lit("/doc/new-"), F.col("doc_id").cast("string")).alias("link"),
        F.col("text"))
    return songs_from_documents(kept).unionByName(added)


def songs_with_holidays(documents: DataFrame) -> DataFrame:
    """Songs of which every ninth also names a holiday."""
    text = F.when(F.col("doc_id") % 9 == 0, F.concat("text", F.lit(" Merry Christmas!"))).otherwise(F.col("text"))
    return songs_from_documents(documents.withColumn("text", text))


def damaged_vectors(vectors: DataFrame, dim: int, vec: str = "emotions_embeddings") -> DataFrame:
    """Vectors of which some are null, too short, zero, or hold NaN or infinity, by the link's
    number; the stored norm is dropped."""
    no = F.regexp_extract("link", "([0-9]+)$", 1).cast("bigint")
    v = F.col(vec)

    def first(value: float) -> F.Column:
        return F.concat(F.array(F.lit(value).cast("float")), F.slice(v, 2, dim - 1))

    bad = (F.when(no % 11 == 0, F.lit(None)).when(no % 13 == 0, F.slice(v, 1, dim - 1))
           .when(no % 17 == 0, F.transform(v, lambda x: F.lit(0).cast("float")))
           .when(no % 19 == 0, first(float("nan"))).when(no % 23 == 0, first(float("inf"))).otherwise(v))
    return vectors.withColumn(vec, bad).drop("norm")
