"""The recommendation plan (M6, M7): sentences in, ten most similar songs out.

For a table of sentences: strip punctuation (F1), label with emotions (M1), embed the labels
(M4, or the raw sentence with ``embed_source='raw'``), and search the index (J2). One DataFrame
plan per step; the only driver hop is the size-checked query broadcast of the search.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import strip_punct
from cadenza.functions.vectors import densify, hashed_pairs, pairs_norm
from cadenza.operators.embed import DEFAULT_DIM, embed
from cadenza.operators.knn import knn_search
from cadenza.operators.label import label_emotions, mood

RESULTS_PER_QUERY = 10  # the reference's num_results

RESULT_COLUMNS = ("query_id", "user_emotions", "rank", "artist", "song", "link",
                  "llm_labeled_emotions", "score")


Labeler = Callable[[DataFrame], DataFrame]
Embedder = Callable[[DataFrame], DataFrame]


def song_vectors(songs: DataFrame, lexicon: DataFrame | None = None, dim: int = DEFAULT_DIM,
                 cleaner: str | None = "v2", labeler: Labeler | None = None,
                 embedder: Embedder | None = None) -> DataFrame:
    """Songs to the embeddings table: artist, song, link, labels, vector, norm (text dropped).

    ``labeler`` (adds ``llm_labeled_emotions`` from ``text``) and ``embedder`` (adds
    ``emotions_embeddings`` and ``norm`` from ``llm_labeled_emotions``) replace the defaults.
    """
    base = songs.select("artist", "song", "link", "text")
    labeled = (label_emotions(base, lexicon, cleaner=cleaner) if labeler is None else labeler(base)).select(
        "artist", "song", "link", "llm_labeled_emotions")
    if embedder is None:
        return embed(labeled, dim=dim)
    return embedder(labeled)


def query_vectors(sentences: DataFrame, lexicon: DataFrame | None = None, dim: int = DEFAULT_DIM,
                  embed_source: str = "labels", labeler: Labeler | None = None,
                  embedder: Embedder | None = None) -> DataFrame:
    """Sentences to query rows: query_id, user_emotions, query_vec, query_norm.

    A sentence is labeled with the emotions it has, however few; one without any has null
    ``user_emotions`` and, embedded by its labels, no vector, so no answer. A plug-in ``labeler``
    reads ``text`` and adds ``llm_labeled_emotions``; a plug-in ``embedder`` reads
    ``llm_labeled_emotions`` and adds ``emotions_embeddings`` (the same functions as for songs).
    """
    if embed_source not in ("labels", "raw"):
        raise ValueError("embed_source must be 'labels' or 'raw'")
    clean = sentences.select("query_id", strip_punct("user_input").alias("text"))
    if labeler is None:
        labeled = mood(clean, lexicon)
    else:
        labeled = labeler(clean).withColumnRenamed("llm_labeled_emotions", "user_emotions")
    source = "user_emotions" if embed_source == "labels" else "text"
    if embedder is not None:
        out = embedder(labeled.select("query_id", "user_emotions", F.col(source).alias("llm_labeled_emotions")))
        return out.select("query_id", "user_emotions", F.col("emotions_embeddings").alias("query_vec"),
                          F.col("norm").alias("query_norm"))
    pairs = labeled.select("query_id", "user_emotions", hashed_pairs(source, dim).alias("_pairs"))
    return pairs.select("query_id", "user_emotions", densify("_pairs", dim).alias("query_vec"),
                        pairs_norm("_pairs").alias("query_norm"))


def recommend(sentences: DataFrame, index: DataFrame, lexicon: DataFrame | None = None, *,
              k: int = RESULTS_PER_QUERY, dim: int = DEFAULT_DIM, embed_source: str = "labels",
              labeler: Labeler | None = None, embedder: Embedder | None = None,
              **search_options) -> DataFrame:
    """Top ``k`` songs per sentence: ``query_id, user_emotions, rank, artist, song, link,
    llm_labeled_emotions, score``. Use the same labeler and embedder as for the index."""
    queries = query_vectors(sentences, lexicon, dim, embed_source, labeler, embedder)
    hits = knn_search(queries, index, dim=dim, k=k, query_key="query_id", query_vec="query_vec",
                      index_key="link", index_vec="emotions_embeddings",
                      payload=["artist", "song", "llm_labeled_emotions"],
                      query_payload=["user_emotions"], query_norm="query_norm",
                      index_norm="norm" if "norm" in index.columns else None,
                      **{"few_vectors": True, **search_options})
    return hits.select(*RESULT_COLUMNS)
