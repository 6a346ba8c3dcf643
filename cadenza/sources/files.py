"""Files and tables: CSV scan (S1), table overwrite (S4/S5), namespaces (S6), JSON sink.

Everything written goes under the session's shared folder (``spark.checkpoint.dir``), never to
a machine-local folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from cadenza.session import scratch_path

SONGS_CSV_SCHEMA = StructType([StructField(c, StringType()) for c in ("artist", "song", "link", "text")])

# CSV options of the song file: header, comma, quoted fields over several lines, and a
# doubled double quote inside a quoted field stands for one quote ('escape' = '"').
CSV_READ_OPTIONS = {"header": "true", "sep": ",", "multiLine": "true", "escape": '"', "quote": '"'}
CSV_WRITE_OPTIONS = {"header": "true", "sep": ",", "escape": '"', "quote": '"',
                     "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_songs_csv(spark: SparkSession, path: str, schema: StructType = SONGS_CSV_SCHEMA) -> DataFrame:
    """Read a song CSV with a declared schema (no inference pass).

    ``multiLine`` files cannot be split, so parallelism comes from the number of files:
    write many part files for large inputs.
    """
    return spark.read.schema(schema).options(**CSV_READ_OPTIONS).csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(path)
    return path


def ensure_namespace(spark: SparkSession, name: str) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` with its location in the shared folder.

    One statement per call: Spark's parser takes a single statement.
    """
    location = scratch_path(spark, f"schema-{name}")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}` LOCATION '{location}'")


def use_namespace(spark: SparkSession, name: str) -> str:
    """``USE`` of a namespace, which is made if it is missing (S6); returns the one used before.
    Table names without a namespace then belong to it."""
    before = spark.catalog.currentDatabase()
    ensure_namespace(spark, name)
    spark.sql(f"USE `{name}`")
    return before


def overwrite_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """``write.mode('overwrite').saveAsTable`` at an explicit shared path.

    Overwrite replaces the schema. The target must not be read by ``df`` itself (Spark
    refuses that); write a new path and switch instead.
    """
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def write_json(df: DataFrame, path: str) -> DataFrame:
    """Write rows as JSON lines (the prompt-trial artifact, S7) and read them back."""
    df.write.mode("overwrite").json(path)
    return df.sparkSession.read.schema(df.schema).json(path)


def ingest_songs(spark: SparkSession, csv_path: str, table: str, table_path: str,
                 fraction: float, key: str = "link") -> DataFrame:
    """CSV of songs → hash sample on the key → saved table (S1, L4, S4): one job that reads the
    CSV once (declared schema), filters map-side and writes; the table is read back."""
    from cadenza.operators.measures import sample_by_key

    sample = sample_by_key(read_songs_csv(spark, csv_path), key, fraction)
    return overwrite_table(sample, table, table_path)
