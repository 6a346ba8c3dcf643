"""Triggered incremental refresh of the vector index (T1, the streaming form of S10).

New song rows and deletions arrive as files (a change feed) in a folder. A Structured
Streaming query with ``trigger(availableNow=True)`` picks up only the files not seen before
(the checkpoint remembers them), and ``foreachBatch`` turns each micro-batch into one delta
version of the index (see :mod:`cadenza.operators.index`):

1. keep the newest change per key within the batch (WindowGroupLimit),
2. label and embed the upserted rows (the same plans as the batch path),
3. write them with their ``seq``; deleted rows, and rows no longer fit for the index, become
   tombstones.

Versions are numbered after those that exist, whoever wrote them, so a stream can start on an
index built in batch, and a new checkpoint never overwrites one. A retried epoch finds the
version it wrote by the stream's id and its epoch, and rewrites it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cadenza.operators import index as X
from cadenza.operators.embed import embed
from cadenza.operators.label import label_emotions

CHANGE_SCHEMA = StructType([
    StructField("artist", StringType()),
    StructField("song", StringType()),
    StructField("link", StringType()),
    StructField("text", StringType()),
    StructField("change", StringType()),   # 'upsert' or 'delete'
    StructField("seq", LongType()),        # order of changes to the same key
])
UPSERT, DELETE = "upsert", "delete"

INDEX_COLUMNS = ("artist", "song", "link", "llm_labeled_emotions", "emotions_embeddings", "norm")


def changes_from_rows(rows: DataFrame, seq: int, change: str = UPSERT) -> DataFrame:
    """Song rows as change records."""
    return rows.select("artist", "song", "link", "text", F.lit(change).alias("change"),
                       F.lit(seq).cast("bigint").alias("seq"))


def changes_from_diff(new: DataFrame, diff: DataFrame, seq: int) -> DataFrame:
    """Change records for a snapshot diff: upserts carry the new rows, deletes only the key."""
    ups = changes_from_rows(X.changed_rows(new, diff), seq)
    dels = diff.where(F.col("change") == X.DELETE).select(
        F.lit(None).cast("string").alias("artist"), F.lit(None).cast("string").alias("song"), "link",
        F.lit(None).cast("string").alias("text"), F.lit(DELETE).alias("change"),
        F.lit(seq).cast("bigint").alias("seq"))
    return ups.unionByName(dels)


def delta_of(batch: DataFrame, lexicon: DataFrame, dim: int) -> DataFrame:
    """The delta version of one batch of changes: index columns, ``seq``, ``deleted``."""
    latest = X.latest_per_key(batch, "link", [F.desc("seq"), F.desc("change")])
    gone = F.col("change") == DELETE
    # a deletion goes through the same row-wise plan with a null text, which has no vector
    rows = latest.withColumn("text", F.when(~gone, F.col("text")))
    state = embed(label_emotions(rows, lexicon).drop("text"), dim=dim).withColumn(
        "deleted", gone | ~X.fit(dim, check_dim=False))
    live = ~F.col("deleted")
    return state.select(*[c if c == "link" else F.when(live, F.col(c)).alias(c) for c in INDEX_COLUMNS],
                        F.coalesce("seq", F.lit(0)).alias("seq"), "deleted")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of this checkpoint (a new one after a loss)."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def start_index_stream(spark: SparkSession, source_dir: str, index_base: str, checkpoint: str,
                       lexicon: DataFrame, dim: int) -> StreamingQuery:
    """Start one ``availableNow`` run over the change folder; returns the running query."""
    changes = spark.readStream.schema(CHANGE_SCHEMA).parquet(source_dir)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        source = f"{stream_id(spark, checkpoint)}/{epoch_id}"
        X.write_version(delta_of(batch, lexicon, dim), index_base, X.DELTA, source)

    return (changes.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def run_index_stream(spark: SparkSession, source_dir: str, index_base: str, checkpoint: str,
                     lexicon: DataFrame, dim: int) -> DataFrame | None:
    """Run the stream until the folder is drained; return the index."""
    query = start_index_stream(spark, source_dir, index_base, checkpoint, lexicon, dim)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return X.read_index(spark, index_base)
