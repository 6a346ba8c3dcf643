"""The batch steps as written tables: lexicon → labels → embeddings → index.

Each stage reads the table the previous stage wrote, so every stage runs once, measures are
taken on what was saved (not on a second run of a model), and a lost executor only redoes work
inside the stage it was in: the written tables cut the lineage. Everything lives under one root
in the shared folder; the index is kept in versions (see :mod:`cadenza.operators.index`), so
the triggered stream (:mod:`cadenza.streaming.index_stream`) can continue from it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cadenza.operators import index as X
from cadenza.operators import ivf as V
from cadenza.operators.embed import DEFAULT_DIM, embed
from cadenza.operators.label import build_lexicon, label_emotions, materialize_lexicon
from cadenza.plans.recommend import RESULT_COLUMNS, RESULTS_PER_QUERY, query_vectors, recommend

IVF_PAYLOAD = ["artist", "song", "llm_labeled_emotions"]


@dataclass(frozen=True)
class Store:
    root: str

    @property
    def lexicon(self) -> str:
        return f"{self.root}/lexicon"

    @property
    def labeled(self) -> str:
        return f"{self.root}/labeled"

    @property
    def embeddings(self) -> str:
        return f"{self.root}/embeddings"

    @property
    def index(self) -> str:
        return f"{self.root}/index"

    @property
    def ivf_model(self) -> str:
        return f"{self.root}/ivf_model"

    @property
    def ivf_cells(self) -> str:
        return f"{self.root}/ivf_cells"


def build_store(songs: DataFrame, root: str, dim: int = DEFAULT_DIM, cleaner: str | None = "v2",
                drop_errors: bool = True, bucketed: bool = False, ivf_cells: int = 0,
                sparse: bool = False) -> Store:
    """Write the lexicon, the labeled songs (without text), the embeddings and a base version of
    the index under ``root``; ``bucketed`` buckets it by ``link``, in buckets sized from its rows
    (see :func:`cadenza.operators.index.write_version`); ``ivf_cells > 0`` also writes an inverted
    file (centres: the rows whose keys hash lowest) for approximate serving; ``sparse=True`` stores
    the vectors as (indices, values) instead of ``dim`` floats (not with the inverted file, whose
    centres are dense vectors)."""
    if sparse and ivf_cells > 0:
        raise ValueError("the inverted file needs dense vectors")
    spark = songs.sparkSession
    store = Store(root)
    build_lexicon(songs).write.mode("overwrite").parquet(store.lexicon)
    lexicon = materialize_lexicon(spark.read.parquet(store.lexicon))
    labels = label_emotions(songs.select("artist", "song", "link", "text"), lexicon, cleaner=cleaner)
    labels.drop("text").write.mode("overwrite").parquet(store.labeled)
    embed(spark.read.parquet(store.labeled), dim=dim, sparse=sparse).write.mode("overwrite").parquet(store.embeddings)
    vectors = spark.read.parquet(store.embeddings)
    index = X.build_index(vectors, dim=dim, drop_errors=drop_errors, check_dim=False)
    X.write_version(index, store.index, bucket_by="link",
                    buckets=X.bucket_count(vectors.count(), dim) if bucketed else 0)
    if ivf_cells > 0:
        stored = X.read_index(spark, store.index)
        model = V.hash_pivots(stored, "emotions_embeddings", dim, ivf_cells, "link")
        model.save(spark, store.ivf_model)
        V.write_cells(stored, model, store.ivf_cells, dim=dim, index_key="link", index_vec="emotions_embeddings",
                      payload=IVF_PAYLOAD, covers=max(X.list_versions(spark, store.index)))
    return store


def refresh_ivf(spark: SparkSession, store: Store, dim: int = DEFAULT_DIM) -> V.Cells:
    """The inverted file's centres, once it covers the index's newest version (see
    :func:`cadenza.operators.ivf.refresh_cells`)."""
    model = V.Cells.load(spark, store.ivf_model)
    V.refresh_cells(spark, store.index, model, store.ivf_cells, dim=dim, payload=IVF_PAYLOAD)
    return model


def open_lexicon(spark: SparkSession, store: Store) -> DataFrame:
    return materialize_lexicon(spark.read.parquet(store.lexicon))


def open_index(spark: SparkSession, store: Store) -> DataFrame:
    index = X.read_index(spark, store.index)
    if index is None:
        raise FileNotFoundError(f"no index version under {store.index}")
    return index


def recommend_from_store(sentences: DataFrame, store: Store, dim: int = DEFAULT_DIM,
                         nprobe: int | None = None, k: int = RESULTS_PER_QUERY, **options) -> DataFrame:
    """Answer sentences from a stored index (the serving path: nothing is rebuilt).

    With ``nprobe``, search the stored inverted file instead: only the folders of the
    ``nprobe`` cells nearest to each sentence are read (approximate; see
    :mod:`cadenza.operators.ivf`). Changes to the index since the file's last version are
    added to it first, so what the index deleted is not served.
    """
    spark = sentences.sparkSession
    lexicon = open_lexicon(spark, store)
    if nprobe is None:
        return recommend(sentences, open_index(spark, store), lexicon, dim=dim, k=k, **options)
    model = refresh_ivf(spark, store, dim)
    queries = query_vectors(sentences, lexicon, dim, **options)
    hits, _ = V.ivf_search_stored(queries, store.ivf_cells, model, dim=dim, k=k, nprobe=nprobe,
                                  query_key="query_id", query_vec="query_vec", query_norm="query_norm",
                                  query_payload=["user_emotions"], index_key="link",
                                  index_vec="emotions_embeddings",
                                  payload=IVF_PAYLOAD)
    return hits.select(*RESULT_COLUMNS)
