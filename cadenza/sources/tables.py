"""Reading the test tables and mapping them to the songs and sentences tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

SONG_COLUMNS = ("artist", "song", "link", "text")


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan of fewer splits than cores over all cores, before CPU-heavy work per row.

    A parquet file is split by row groups, so a small file is read by one task. Inputs of more
    splits are parallel already and stay as they are. Only the plan's number of splits is asked
    for; filters and column pruning still reach the scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table (parquet): filters and column choices reach the scan."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def song_link(doc_id) -> F.Column:
    return F.concat(F.lit("/doc/"), F.col(doc_id).cast("string"))


def songs_from_documents(documents: DataFrame) -> DataFrame:
    """The songs table: artist = source, song = 'doc-' || doc_id, link = '/doc/' || doc_id."""
    return documents.select(
        F.col("source").alias("artist"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("song"),
        song_link("doc_id").alias("link"),
        F.col("text"),
    )


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return songs_from_documents(read_table(spark, sf_dir, "documents"))


def sentences_from_conversations(conversations: DataFrame) -> DataFrame:
    """User input table: every user turn, ``query_id = "{conv_id}/{turn}"``."""
    return conversations.where(F.col("role") == "user").select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query_id"),
        F.col("text").alias("user_input"),
    )


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences_from_conversations(read_table(spark, sf_dir, "conversations"))


def scan_limit(df: DataFrame, key: str, n: int) -> DataFrame:
    """``select * ... limit n`` made repeatable: the first n rows by key (S3, L1, L2)."""
    return df.orderBy(F.asc(key)).limit(n)
