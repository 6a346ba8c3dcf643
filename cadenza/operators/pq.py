"""Approximate search by product quantisation, with exact re-ranking (M8).

* **Books**: a unit vector is cut into ``parts`` pieces of equal width; each piece has a codebook of
  at most 256 entries. Components are integers (``floor(SCALE * x / |x|)``) and a book's entries are
  trained by Lloyd's rounds with exact integer sums, so any engine gets the same books and codes.
  Training reads the whole index once a round: a task sums its rows per (piece, entry), Spark adds
  the tasks' sums, and only the books (``entries x dim`` integers) reach the driver.
* **Codes**: one byte per piece and row, the stored form of the index (:func:`write_codes`): 768
  floats become 96 bytes. Encoding is map-only, so changed rows can be encoded alone.
* **Search**: a row's estimate is the dot product of the query's integers with the entries its codes
  name, computed for blocks of decoded rows as one matrix product of exact integers. Codes that fit a
  broadcast are sent to the queries, so a task finds a query's best ``rerank`` rows at once; else the
  queries are sent to the codes and the tasks' best rows merge. These rows alone meet their full vectors, by a join on the key (of the index only
  candidates' rows leave the scan where the candidates fit a broadcast), and are ranked by the exact
  cosine. Ties go by key, so answers do not depend on the partitioning.

Rows without a usable vector (null, short, zero, not finite) have no code and no answers. Books of
an empty index are empty, and so are all answers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from cadenza.llm.common import bounded_batches
from cadenza.operators.ivf import _index_rows, _queries, hash_pivots
from cadenza.operators.knn import (DEFAULT_BROADCAST_BYTES, OUT_ROWS, SCORE_CELLS, _Best, _matrix, _scaled_round, _score_block,
                                   _valid_rows)
from cadenza.session import scratch_path, shuffles_removed

SCALE = 4096
MAX_ENTRIES = 256               # a code is a byte
DECODED_BYTES = 4 << 20         # of codes decoded at once
QUERY_ROWS = 4096               # queries whose best rows a task holds at once


@dataclass(frozen=True)
class Books:
    """``parts x entries x width`` integers; the vectors' width is ``parts * width``."""

    entries: np.ndarray

    @property
    def dim(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Nearest entry of every piece of integer rows (ties: the smaller number), ``rows x parts`` bytes."""
        parts, n, width = self.entries.shape
        out = np.empty((len(x), parts), dtype=np.uint8)
        pieces = x.reshape(len(x), parts, width)
        step = max(1, SCORE_CELLS // max(n, 1))
        for p in range(parts):
            book = self.entries[p].astype(np.float64)
            half = (book * book).sum(axis=1) / 2
            for lo in range(0, len(x), step):
                out[lo:lo + step, p] = np.argmin(half - pieces[lo:lo + step, p] @ book.T, axis=1)
        return out

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The vectors that codes (bytes, ``parts`` a row) stand for, as doubles."""
        parts = len(self.entries)
        codes = codes.reshape(-1, parts)
        return self.entries[np.arange(parts)[None, :], codes].reshape(len(codes), self.dim).astype(np.float64)

    def save(self, spark: SparkSession, path: str) -> None:
        parts, n, _ = self.entries.shape
        rows = [(p, e, self.entries[p, e].tolist()) for p in range(parts) for e in range(n)]
        spark.createDataFrame(rows, "part int, entry int, value array<bigint>").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Books":
        rows = spark.read.parquet(path).orderBy("part", "entry").collect()       # the books: bounded
        if not rows:
            return Books(np.empty((0, 0, 0), dtype=np.int64))
        parts = rows[-1]["part"] + 1
        values = np.array([r["value"] for r in rows], dtype=np.int64)
        return Books(values.reshape(parts, len(rows) // parts, -1))


def _integers(x: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return np.floor(x / norms[:, None] * SCALE)


def _rows(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The usable rows of every batch and their integer components."""
    for b in batches:
        t = _valid_rows(pa.Table.from_batches([b]), "_iv", "_in", dim, "cosine")
        if t.num_rows:
            yield t, _integers(_matrix(t.column("_iv"), dim), t.column("_in").to_numpy(zero_copy_only=False))


def train_books(index: DataFrame, *, dim: int, parts: int, entries: int = MAX_ENTRIES, rounds: int = 4,
                index_key: str = "link", index_vec: str = "emotions_embeddings", index_norm: str | None = None) -> Books:
    """Codebooks from all rows of the index. They start at the pieces of the ``entries`` usable rows
    whose keys hash lowest; an entry nearest to nothing stays as it is. Give a stored index: it is
    read once a round."""
    if not 0 < entries <= MAX_ENTRIES or parts < 1 or dim % parts:
        raise ValueError(f"entries must be in 1..{MAX_ENTRIES}, and dim a multiple of parts")
    width = dim // parts
    spark = index.sparkSession
    start = hash_pivots(index, index_vec, dim, entries, index_key).centers
    start = np.asarray(start, dtype=np.float64).reshape(-1, dim)
    books = Books(np.floor(start * SCALE).astype(np.int64).reshape(-1, parts, width).transpose(1, 0, 2).copy())
    if not len(start):
        return books
    rows = _index_rows(index, index_key, index_vec, [], index_norm).select("_iv", "_in")
    schema = StructType([StructField("part", IntegerType()), StructField("entry", IntegerType()), StructField("n", LongType())]
                        + [StructField(f"s{i}", LongType()) for i in range(width)])
    arrow = to_arrow_schema(schema)
    for _ in range(rounds):
        shipped = spark.sparkContext.broadcast(books)

        def sums(batches, shipped=shipped):
            own = shipped.value
            n_entries = own.entries.shape[1]
            n = np.zeros((parts, n_entries), dtype=np.int64)
            total = np.zeros((parts, n_entries, width), dtype=np.int64)
            for _, x in _rows(batches, dim):
                codes = own.encode(x)
                pieces = x.reshape(len(x), parts, width)
                for p in range(parts):
                    n[p] += np.bincount(codes[:, p], minlength=n_entries)
                    for i in range(width):       # sums of a batch stay below 2^53
                        total[p, :, i] += np.bincount(codes[:, p], pieces[:, p, i], n_entries).astype(np.int64)
            p, e = np.nonzero(n)
            cols = [p.astype(np.int32), e.astype(np.int32), n[p, e]] + [total[p, e, i] for i in range(width)]
            yield from pa.table([pa.array(c) for c in cols], schema=arrow).to_batches()

        found = (rows.mapInArrow(sums, schema).groupBy("part", "entry")
                 .agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)]).collect())
        values = books.entries.copy()
        for r in found:                          # parts x entries rows at most
            values[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
        shipped.unpersist()
        if (values == books.entries).all():
            break
        books = Books(values)
    return books


def encode(index: DataFrame, books: Books, *, index_key: str = "link", index_vec: str = "emotions_embeddings",
           index_norm: str | None = None) -> DataFrame:
    """``(index_key, codes)`` of every usable row; map-only."""
    dim = books.dim
    rows = _index_rows(index, index_key, index_vec, [], index_norm)
    schema = StructType([StructField(index_key, rows.schema["_ik"].dataType), StructField("codes", BinaryType())])
    arrow = to_arrow_schema(schema)
    shipped = index.sparkSession.sparkContext.broadcast(books)

    def code(batches):
        for t, x in _rows(batches, dim):
            codes = shipped.value.encode(x)
            out = pa.table({index_key: t.column("_ik"), "codes": pa.array([c.tobytes() for c in codes], pa.binary())})
            yield from out.cast(arrow).to_batches()

    return rows.mapInArrow(code, schema)


def write_codes(index: DataFrame, books: Books, path: str, **names) -> str:
    """The coded index under ``path``: ``codes`` (a byte per piece) and ``books``."""
    encode(index, books, **names).write.mode("overwrite").parquet(f"{path}/codes")
    books.save(index.sparkSession, f"{path}/books")
    return path


def pq_candidates(queries: DataFrame, codes: DataFrame, books: Books, rerank: int, *, query_key: str = "query_id",
                  query_vec: str = "query_vec", index_key: str = "link", exclude_self: bool = False,
                  max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``query_key, index_key, estimate``: the ``rerank`` rows of largest estimated dot product per
    query, ties by key. Queries beyond the broadcast budget go in blocks, a scan of the codes each."""
    held = _small_codes(codes, books, index_key, max_broadcast_bytes)

    def answers(q: pa.Table):
        shipped = _shipped(codes.sparkSession, q, books.dim)
        return _estimate(q, codes, books, rerank, index_key, exclude_self, held, shipped), shipped

    return _by_block(_queries(queries, query_key, query_vec), books.dim, max_broadcast_bytes, answers)


def pq_search(queries: DataFrame, index: DataFrame, codes: DataFrame, books: Books, *, k: int = 10, rerank: int = 100,
              query_key: str = "query_id", query_vec: str = "query_vec", index_key: str = "link",
              index_vec: str = "emotions_embeddings", index_norm: str | None = None, payload: Sequence[str] = (),
              exclude_self: bool = False, digits: int = 6, max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Top ``k`` per query, by exact cosine among the ``rerank`` best estimates: ``query_key, rank,
    index_key, payload..., score``. Keys must be unique on each side."""
    if query_key == index_key or rerank < k:
        raise ValueError("output column names of the two sides must differ, and rerank be at least k")
    x = _index_rows(index, index_key, index_vec, payload, index_norm)

    held = _small_codes(codes, books, index_key, max_broadcast_bytes)

    def answers(q: pa.Table):
        shipped = _shipped(x.sparkSession, q, books.dim)
        found = _estimate(q, codes, books, rerank, index_key, exclude_self, held, shipped)
        return _rerank(q, shipped, found, x, books.dim, k, query_key, index_key, payload, digits), shipped

    return _by_block(_queries(queries, query_key, query_vec), books.dim, max_broadcast_bytes, answers)


def _by_block(q: DataFrame, dim: int, max_broadcast_bytes: int, answers) -> DataFrame:
    """``answers`` (with the broadcast of its queries) of all queries at once, or of hash blocks of them
    that fit the budget, each written; then its broadcast and its shuffle files go."""
    spark = q.sparkSession
    cap = max(1, max_broadcast_bytes // (8 * dim + 64))
    local = q.limit(cap + 1).toArrow()
    if local.num_rows <= cap:
        return answers(_valid_rows(local, "_qv", "_qn", dim, "cosine"))[0]
    held, out = scratch_path(spark, "pq-queries"), scratch_path(spark, "pq-answers")
    blocks = math.ceil(2 * q.count() / cap)      # hash blocks of half the budget, so an uneven one fits
    (q.withColumn("_block", F.pmod(F.xxhash64("_qk"), F.lit(blocks)).cast("int")).repartition("_block")
     .write.partitionBy("_block").parquet(held))
    stored = spark.read.schema(StructType(q.schema.fields + [StructField("_block", IntegerType())])).parquet(held)
    with shuffles_removed(spark):
        for b in range(blocks):
            local = stored.where(F.col("_block") == b).drop("_block").toArrow()
            found, shipped = answers(_valid_rows(local, "_qv", "_qn", dim, "cosine"))
            found.write.mode("append").parquet(out)
            shipped.destroy()
    return spark.read.parquet(out)


def _shipped(spark: SparkSession, q: pa.Table, dim: int):
    keys, norms = q.column("_qk").combine_chunks(), q.column("_qn").to_numpy().astype(np.float64)
    return spark.sparkContext.broadcast((keys, _matrix(q.column("_qv"), dim), norms))


def _small_codes(codes: DataFrame, books: Books, index_key: str, max_broadcast_bytes: int):
    """The broadcast of keys and codes, if they fit one."""
    cap = max(1, max_broadcast_bytes // (len(books.entries) + 24))
    bounded_batches(codes.sparkSession)
    local = codes.select(index_key, "codes").limit(cap + 1).toArrow()
    if local.num_rows > cap or local.nbytes > max_broadcast_bytes:
        return None
    return codes.sparkSession.sparkContext.broadcast(local)


def _estimate(q: pa.Table, codes: DataFrame, books: Books, rerank: int, index_key: str, exclude_self: bool,
              held=None, queries=None) -> DataFrame:
    """``_q`` (a query's number in ``q``), ``index_key, estimate``: the best ``rerank`` rows of every query.

    ``queries``: their broadcast, if there is one. ``held``: the broadcast of all codes. Every task then takes some of the queries and finds their
    best rows; else every task takes some of the codes, and the tasks' best rows of a query merge."""
    spark = codes.sparkSession
    queries, shipped = queries or _shipped(spark, q, books.dim), spark.sparkContext.broadcast(books)
    schema = StructType([StructField("_q", IntegerType()), StructField(index_key, codes.schema[index_key].dataType),
                         StructField("estimate", LongType())])
    arrow = to_arrow_schema(schema)

    def best_rows(tables, matrix, norms, query_keys, first) -> Iterator[pa.RecordBatch]:
        if not len(matrix):
            return
        own = shipped.value
        wanted, ones = _integers(matrix, norms), np.ones(len(matrix))
        best = _Best(len(matrix), rerank)
        step = max(256, DECODED_BYTES // (8 * own.dim))
        for whole in tables:
            for lo in range(0, whole.num_rows, step):
                t = whole.slice(lo, step)
                ik = t.column(index_key).combine_chunks()
                rows = own.decode(np.frombuffer(b"".join(t.column("codes").to_pylist()), dtype=np.uint8))
                # sums of integers below 2^53, so exact
                found = _score_block(wanted, ones, query_keys, rows, np.ones(len(rows)), ik, rerank, 0, "dot", exclude_self, best.floor)
                best.add(*found, {"_ik": ik})
        found = best.table()
        if found is not None:
            at = pa.array((found.column("_q").to_numpy() + first).astype(np.int32))
            yield from pa.table([at, found.column("_ik"), found.column("score")], schema=arrow).to_batches(OUT_ROWS)

    if held is not None:
        n = q.num_rows
        tasks = max(1, min(n, 4 * spark.sparkContext.defaultParallelism))

        def of_queries(batches):
            keys, matrix, norms = queries.value
            names = keys.to_numpy(zero_copy_only=False)
            for b in batches:
                for task in b.column(0).to_pylist():
                    lo, hi = task * n // tasks, (task + 1) * n // tasks
                    for at in range(lo, hi, QUERY_ROWS):
                        part = slice(at, min(at + QUERY_ROWS, hi))
                        yield from best_rows([held.value], matrix[part], norms[part], names[part], at)

        return spark.range(0, tasks, 1, tasks).mapInArrow(of_queries, schema)

    def of_codes(batches):
        keys, matrix, norms = queries.value
        yield from best_rows((pa.Table.from_batches([b]) for b in batches), matrix, norms, keys.to_numpy(zero_copy_only=False), 0)

    w = Window.partitionBy("_q").orderBy(F.desc("estimate"), F.asc(index_key))
    return (codes.select(index_key, "codes").mapInArrow(of_codes, schema)
            .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= rerank).drop("_rn"))


def _rerank(q: pa.Table, queries, found: DataFrame, x: DataFrame, dim: int, k: int, query_key: str, index_key: str,
            payload: Sequence[str], digits: int) -> DataFrame:
    """Exact scores of the candidates: their rows of the index by key, ``queries`` from their broadcast.

    Spark cannot know how many rows Python makes and would take the candidates for a small table, to
    be broadcast through the driver: both sides are shuffled."""
    spark = x.sparkSession
    rows = found.select("_q", F.col(index_key).alias("_ik")).hint("merge").join(x, "_ik").select("_q", "_ik", "_iv", "_in", *payload)
    fields = {f.name: f for f in x.schema.fields}
    key_type = spark.createDataFrame(q.select(["_qk"]).slice(0, 0)).schema["_qk"].dataType
    schema = StructType([StructField(query_key, key_type), StructField(index_key, fields["_ik"].dataType)]
                        + [StructField(c, fields[c].dataType) for c in payload] + [StructField("score", DoubleType())])
    arrow = to_arrow_schema(schema)
    payload = list(payload)

    def score(batches):
        keys, matrix, norms = queries.value
        for b in batches:
            t = _valid_rows(pa.Table.from_batches([b]), "_iv", "_in", dim, "cosine")
            at = t.column("_q").to_numpy()
            s = np.einsum("ij,ij->i", matrix[at], _matrix(t.column("_iv"), dim))
            s = _scaled_round(s / (norms[at] * t.column("_in").to_numpy(zero_copy_only=False)), digits) / float(10 ** digits)
            cols = [keys.take(pa.array(at)), t.column("_ik"), *[t.column(c) for c in payload], pa.array(s)]
            yield from pa.table(cols, names=arrow.names).cast(arrow).to_batches()

    w = Window.partitionBy(query_key).orderBy(F.desc("score"), F.asc(index_key))
    top = rows.mapInArrow(score, schema).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.select(query_key, "rank", index_key, *payload, "score")
