"""Answering sentences as they arrive (M6 as a stream).

User sentences land as files in a folder. A Structured Streaming query with
``trigger(availableNow=True)`` (or a processing-time trigger for a long-running service) picks
up new files only; ``foreachBatch`` answers each micro-batch from the stored index
(:func:`cadenza.plans.store.recommend_from_store`) and writes the answers of epoch ``e`` to their
own folder. A retried epoch overwrites the same folder, so every sentence is answered once in
the output even when a batch runs twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cadenza.operators.embed import DEFAULT_DIM
from cadenza.plans.recommend import RESULT_COLUMNS, RESULTS_PER_QUERY
from cadenza.plans.store import Store, recommend_from_store

SENTENCE_SCHEMA = "query_id string, user_input string"


def start_answer_stream(spark: SparkSession, source_dir: str, store: Store, out_dir: str,
                        checkpoint: str, k: int = RESULTS_PER_QUERY, dim: int = DEFAULT_DIM,
                        available_now: bool = True, every: str = "10 seconds") -> StreamingQuery:
    sentences = spark.readStream.schema(SENTENCE_SCHEMA).parquet(source_dir)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        answers = recommend_from_store(batch, store, dim=dim, k=k)
        answers.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/epoch={epoch_id:08d}")

    writer = sentences.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


def run_answer_stream(spark: SparkSession, source_dir: str, store: Store, out_dir: str,
                      checkpoint: str, k: int = RESULTS_PER_QUERY, dim: int = DEFAULT_DIM) -> None:
    """One ``availableNow`` run: answer every sentence file not answered before."""
    query = start_answer_stream(spark, source_dir, store, out_dir, checkpoint, k, dim)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def read_answers(spark: SparkSession, out_dir: str) -> DataFrame:
    """All answers written so far (the epoch folders are a partition column, dropped here)."""
    return spark.read.parquet(out_dir).select(*RESULT_COLUMNS)
