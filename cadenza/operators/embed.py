"""Embedding (M4): label strings to fixed-length vectors.

The default embedder is signed feature hashing of the label's words, a pure expression (no
shuffle, no Python). Vectors hold integer counts; ``norm`` is stored next to them, so cosine
scores are exact on any engine. Vectors are dense ``array<float>`` by default, or sparse
``struct<indices, values>`` (``sparse=True``); the search kernels take both. A plug-in embedder
is any function ``DataFrame -> DataFrame`` that adds the vector column, e.g. an iterator pandas
UDF that loads a model once per worker.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.vectors import dense_entries, densify, hashed_pairs, norm, pairs_norm, sparse_vector

DEFAULT_DIM = 768  # vector width of the reference's embedding model


def embed(df: DataFrame, source: str = "llm_labeled_emotions", out: str = "emotions_embeddings",
          dim: int = DEFAULT_DIM, with_norm: bool = True, sparse: bool = False) -> DataFrame:
    """Add the hashed vector of ``source`` (array<float>, ``dim`` wide) and its norm.

    The (bucket, weight) pairs are computed once; the dense vector and the norm both come
    from them (the norm from the non-zero entries only). ``sparse=True`` stores the vector as
    ``struct<indices, values>`` instead (a dozen entries rather than ``dim``); the search
    kernels accept both forms.
    """
    with_pairs = df.select("*", hashed_pairs(source, dim).alias("_pairs"))
    vector = sparse_vector("_pairs") if sparse else densify("_pairs", dim)
    extra = [vector.alias(out)] + ([pairs_norm("_pairs").alias("norm")] if with_norm else [])
    replaced = {out, "norm"} if with_norm else {out}
    return with_pairs.select(*[F.col(c) for c in df.columns if c not in replaced], *extra)


def sparse_rows(vectors: DataFrame, key: str = "link", vec: str = "emotions_embeddings") -> DataFrame:
    """``(key, bucket, weight)`` for the non-zero entries of each vector (map-only)."""
    entries = vectors.select(key, dense_entries(vec))
    return (entries.where(F.col("col") != 0)
            .select(key, F.col("pos").cast("bigint").alias("bucket"), F.col("col").cast("double").alias("weight")))


def dense_rows(vectors: DataFrame, key: str = "link", vec: str = "emotions_embeddings") -> DataFrame:
    """``(key, pos, value)`` for every entry of each vector, zeros included."""
    return vectors.select(key, dense_entries(vec)).select(
        key, F.col("pos").cast("bigint").alias("pos"), F.col("col").cast("double").alias("value"))


def udf_embedder(model: Callable[[Column], Column], source: str = "llm_labeled_emotions",
                 out: str = "emotions_embeddings") -> Callable[[DataFrame], DataFrame]:
    """Wrap a Column-level model returning array<float> as an embedder (adds ``norm``)."""

    def apply(df: DataFrame) -> DataFrame:
        return df.withColumn(out, model(F.col(source))).withColumn("norm", norm(out))

    return apply
