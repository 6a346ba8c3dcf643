"""Calls of a plug-in model whose answers are kept (M1, M4): what a job paid for once it never asks
again.

A hosted model is slow, costs per call and fails now and then. :func:`ask` therefore

* asks every distinct input once, whatever number of rows have it,
* keeps answers in a table under ``store``, by the sha256 of the input and of the model's name, in
  ``slices`` appends, so a job that fails midway loses one slice of calls at most,
* tries a failed input up to ``attempts`` times, and then keeps a row with the error instead of
  failing the job; a later run asks again only what has no answer,
* leaves null inputs out: they have a null answer and no error.

A model is ``model(inputs, attempt) -> answers``, a list as long as the inputs with None for those
that failed; it may also raise, which fails the batch: then its inputs are tried one by one. Batches
hold ``batch`` inputs. A task that Spark repeats (a lost executor, speculation) repeats the calls that
were not yet written; nothing is kept twice for a reader, since per input one answer counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, IntegerType, StringType, StructField, StructType

from cadenza.operators import index as X

Model = Callable[[list[str], int], Sequence]


def input_hash(column: str, name: str) -> F.Column:
    """sha256 of the model's name and the input; null for a null input."""
    return F.sha2(F.concat(F.lit(name), F.lit("\0"), F.col(column)), 256)


def _schema(answer: DataType) -> StructType:
    return StructType([StructField("input_hash", StringType()), StructField("answer", answer),
                       StructField("error", StringType()), StructField("attempts", IntegerType())])


def kept_answers(spark: SparkSession, store: str, answer: DataType | str) -> DataFrame:
    """One row per input asked so far: its answer if any run got one, else its last error, and the
    attempts of all runs."""
    schema = _schema(_type(answer))
    fs, path = X._fs(spark, store)
    if not fs.exists(path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(store)
    best = F.max_by(F.struct("answer", "error"), F.col("error").isNull())
    return (rows.groupBy("input_hash").agg(best.alias("b"), F.sum("attempts").cast("int").alias("attempts"))
            .select("input_hash", "b.answer", "b.error", "attempts"))


def _type(answer: DataType | str) -> DataType:
    return answer if isinstance(answer, DataType) else StructType.fromDDL(f"a {answer}")["a"].dataType


def _tries(model: Model, inputs: list[str], attempts: int) -> list[tuple]:
    """``(answer, error, attempts)`` of every input."""
    out: list = [None] * len(inputs)
    left = list(range(len(inputs)))
    for attempt in range(1, attempts + 1):
        errors = {}

        def call(at: list[int], attempt=attempt, errors=errors):
            try:
                got = model([inputs[i] for i in at], attempt)
                if len(got) != len(at):
                    raise ValueError(f"{len(got)} answers to {len(at)} inputs")
                return list(got)
            except Exception as e:               # whatever a client raises is a failed call
                errors.update({i: f"{type(e).__name__}: {e}" for i in at})
                return None

        got = call(left)
        if got is None:
            got = [(call([i]) or [None])[0] for i in left] if len(left) > 1 else [None]
        for i, answer in zip(left, got):
            out[i] = (answer, None if answer is not None else errors.get(i, "no answer"), attempt)
        left = [i for i in left if out[i][1] is not None]
        if not left:
            break
    return out


def ask(rows: DataFrame, column: str, model: Model, store: str, *, name: str, answer: DataType | str = "string",
        attempts: int = 3, batch: int = 64, slices: int = 1) -> DataFrame:
    """Ask what of ``rows[column]`` has no kept answer; returns :func:`kept_answers` of ``store``.

    ``name`` tells models and their versions apart. Calls run in as many tasks as the distinct
    inputs' shuffle has; the inputs of a task are asked in order, ``batch`` at a time.
    """
    if attempts < 1 or batch < 1 or slices < 1:
        raise ValueError("attempts, batch and slices must be at least 1")
    spark = rows.sparkSession
    schema = _schema(_type(answer))
    arrow = to_arrow_schema(schema)

    def call(batches):
        for b in batches:
            keys, inputs = b.column("input_hash").to_pylist(), b.column("input").to_pylist()
            for lo in range(0, len(keys), batch):
                got = _tries(model, inputs[lo:lo + batch], attempts)
                cols = [keys[lo:lo + batch], *map(list, zip(*got))]
                yield from pa.table([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow).to_batches()

    inputs = (rows.where(F.col(column).isNotNull()).select(input_hash(column, name).alias("input_hash"), F.col(column).alias("input"))
              .groupBy("input_hash").agg(F.any_value("input").alias("input")))
    for s in range(slices):
        known = kept_answers(spark, store, answer).where("error IS NULL").select("input_hash")
        part = inputs.where(F.pmod(F.xxhash64("input_hash"), F.lit(slices)) == s)
        part.join(known, "input_hash", "left_anti").mapInArrow(call, schema).write.mode("append").parquet(store)
    return kept_answers(spark, store, answer)


def attach(rows: DataFrame, column: str, answers: DataFrame, out: str, *, name: str, error: str = "error") -> DataFrame:
    """``rows`` with the kept answer of ``column`` as ``out`` and why there is none as ``error``. Every row
    stays. Rows travel by the input's hash; leave out wide columns that are not needed afterwards."""
    kept = answers.select(F.col("input_hash").alias("_h"), F.col("answer").alias(out), F.col("error").alias(error))
    left = rows.drop(out, error).withColumn("_h", input_hash(column, name))
    return left.join(kept, "_h", "left").drop("_h")
