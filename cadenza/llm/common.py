"""What the operators share: table reads, tables written between steps, Arrow batches.

Steps that must not be computed twice are written as Parquet under the folder the session
names in ``spark.checkpoint.dir`` and read back, so a lost executor never loses them.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.session import scratch_path, shuffles_removed

#: Rows of a broadcast side at most; larger sides are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Arrow batches end at this many bytes, so that many long texts never meet in one batch.
ARROW_BATCH_BYTES = 8 << 20
ARROW_BATCH_ROWS = 4_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by bytes and rows (never raises a bound)."""
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES),
                      ("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_BATCH_ROWS)):
        now = spark.conf.get(key, None)
        try:
            small = now is not None and 0 < int(str(now).rstrip("bB")) <= most
        except ValueError:
            small = False
        if not small:
            spark.conf.set(key, str(most))


class Tables:
    """The tables that one call writes, to be dropped once all that is read from them is written."""

    def __init__(self):
        self.paths: dict[str, str] = {}

    def drop(self, spark: SparkSession, *names: str) -> None:
        """Remove the tables of these names, or all; the shared folder keeps no leftovers."""
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in [p for p, n in self.paths.items() if not names or n in names]:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
            del self.paths[path]


def written(df: DataFrame, name: str, tables: Tables | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, read back: computed once, recomputed never. What was
    shuffled for it goes at once."""
    return written_parts([df], name, tables)


def written_parts(parts: Iterable[DataFrame], name: str, tables: Tables | None = None) -> DataFrame:
    """The rows of all ``parts`` (one or more, of one schema) as one table, written one after the
    other, so that only one of them holds shuffle files."""
    path = None
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        if path is None:
            path = scratch_path(spark, f"llm-{name}")
            if tables is not None:
                tables.paths[path] = name
        with shuffles_removed(spark):
            df.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def row_keys() -> list:
    """``r1, r2``: 128 bits of hash of ``doc_id`` and ``text``, which tell rows apart where ids are null
    or repeat with other texts. Equal rows share them."""
    return [F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64("text", F.lit(1), "doc_id").alias("r2")]


def broadcast_if_small(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint only below a checked number of (narrow) rows."""
    return F.broadcast(df) if rows <= bound else df


def n_blocks(rows: int, block_rows: int) -> int:
    return max(1, math.ceil(rows / block_rows))


# ---------------------------------------------------------------- words as numpy arrays

CHUNK_BYTES = 512 << 10
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Separators of words without punctuation: ASCII characters but letters and digits.
_PUNCT = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (public splitmix finaliser), vectorised."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column and each row's offsets; nulls are empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


class Words:
    """Words (runs of bytes other than ASCII white space) of the rows ``lo..hi``.

    ``start``/``end`` are byte positions in ``data``, ``row`` the row of each word counted
    from ``lo``, ``offsets`` the rows' byte offsets in ``data``. ``apart`` marks the bytes that
    separate words.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lo: int, hi: int, apart: np.ndarray = _SPACE):
        self.lo, self.hi, self.rows = lo, hi, hi - lo
        self.offsets = offsets[lo:hi + 1] - offsets[lo]
        self.data = data[offsets[lo]:offsets[hi]]
        inside = ~apart[self.data]
        cuts = self.offsets[:-1][self.offsets[:-1] < len(self.data)]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:] = inside[:-1]
        before[cuts] = False
        after[:-1] = inside[1:]
        after[cuts[cuts > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.row = np.searchsorted(self.offsets, self.start, "right") - 1
        self.count = np.bincount(self.row, minlength=self.rows).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.count)))

    def hashes(self, lower: bool, most: int | None = None) -> np.ndarray:
        """A 64-bit hash per word: a polynomial of its (first ``most``) bytes, mixed."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        lens = self.end - self.start
        powers = np.cumprod(np.full(int(lens.max()), _ODD, np.uint64))
        first = np.concatenate(([0], np.cumsum(lens)[:-1]))
        at = np.arange(int(lens.sum())) - np.repeat(first, lens)
        byte = self.data[at + np.repeat(self.start, lens)]
        if lower:
            byte = _LOWER[byte]
        terms = (byte.astype(np.uint64) + np.uint64(1)) * powers[at]
        if most is not None:
            terms[at >= most] = 0
        return mix64(np.add.reduceat(terms, first))


def word_chunks(column, apart: np.ndarray = _SPACE) -> Iterator[Words]:
    """A column's words in chunks of whole rows, of about ``CHUNK_BYTES`` each."""
    data, offsets = text_bytes(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + CHUNK_BYTES, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Words(data, offsets, lo, hi, apart)
        lo = hi


def chain(parts: list[np.ndarray]) -> np.ndarray:
    """One 64-bit hash of several aligned hash arrays, in order."""
    acc = np.zeros_like(parts[0])
    for p in parts:
        acc = mix64(acc * _ODD + p)
    return acc
