"""Mixing sources to target weights (operator 2): cube-method balanced sampling.

Every document of a source is taken ``floor(r)`` times for the source's rate r = target /
size, and once more with probability r - floor(r). The extra takings are drawn by the cube
method: the vector of probabilities walks through the null space of two constraints, the
total of sizes and the number of documents, until each entry is 0 or 1. The walk needs only
a few open documents at a time, so it streams through sorted rows of any number. Blocks of a
source walk in parallel, each leaving at most two open documents; those walk again in ever
fewer blocks, and the last few of a source are landed where they miss the token total least.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from cadenza.llm.common import Tables, bounded_batches, broadcast_if_small, written

#: Documents of a source that walk together; a block leaves two open at most.
BLOCK_ROWS = 2000
#: Documents that a source's last block leaves to the landing at most.
LANDING = 11
_EPS = 1e-9


def word_count(text: str = "text") -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """``(source, source_size, source_rows, target)``, one row per source (null is a source).

    Sources in code point order, null last, take the weights in turn. ``share`` of all sizes
    is dealt by weight; a target stops at ``most`` times its source's size and the excess is
    dealt anew. That is the level at which min(cap, level * weight) adds up to the share: with
    sources sorted by cap / weight it is found by running sums, over one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), turn.cast("int") + 1)
    cap = F.col("source_size") * F.lit(float(most))
    per = per.withColumn("w", w).withColumn("cap", cap).withColumn("at", F.col("cap") / F.col("w"))
    whole = Window.partitionBy(F.lit(0))
    before = whole.orderBy("at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("total", F.sum("source_size").over(whole) * F.lit(float(share)))
           .withColumn("w_left", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
           .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.col("w_left")))
    # the first level that does not fill the sources from there on is the level of all
    per = per.withColumn("nth", F.row_number().over(whole.orderBy("at", F.col("source").asc_nulls_last())))
    per = per.withColumn("level", F.coalesce(
        F.min(F.when(F.col("level") <= F.col("at"), F.struct("nth", "level"))).over(whole)["level"],
        F.max("at").over(whole)))
    return per.select("source", "source_size", "source_rows",
                      F.least("cap", F.col("level") * F.col("w")).alias("target"))


def _direction(sizes: list[float]) -> list[float]:
    """A vector of the null space of the two constraints, rows (size) and (1), for three."""
    a, b, c = sizes
    u = [b - c, c - a, a - b]
    return u if any(u) else [1.0, -1.0, 0.0]


def _step(p: list[float], u: list[float], draw: float) -> list[float]:
    """One martingale step along ``u`` until an entry is 0 or 1."""
    up = min(((1 - x) / d if d > 0 else x / -d) for x, d in zip(p, u) if d)
    down = min((x / d if d > 0 else (1 - x) / -d) for x, d in zip(p, u) if d)
    by = up if draw * (up + down) < down else -down
    return [min(1.0, max(0.0, x + by * d)) for x, d in zip(p, u)]


def _open(x: float) -> bool:
    return _EPS < x < 1 - _EPS


def _land(open_: list[list], draw: np.random.RandomState) -> None:
    """The landing problem: of all 0/1 outcomes of the last entries the one that misses the
    token total least; a draw decides between equals."""
    p, size = np.array([x[2] for x in open_]), np.array([x[3] for x in open_])
    outcomes = (np.arange(2 ** len(p))[:, None] >> np.arange(len(p))) & 1
    miss = np.abs((outcomes - p) @ size)
    best = outcomes[draw.choice(np.flatnonzero(miss <= miss.min() + 1e-6))]
    for x, value in zip(open_, best):
        x[2] = float(value)


def _walk(batches):
    """Rows sorted by (source, block): every document's probability after the walk.

    The last block of a source keeps ``LANDING`` documents open, which it lands; others leave
    two. Rows are held only while open; the others pass on with their batch.
    """
    import pyarrow as pa

    # open_: [held row, row of this batch, probability, size]
    key, open_, draw, names, keep = None, [], None, None, 0

    def held(row, p):
        return pa.RecordBatch.from_arrays(
            [pa.array([p]) if n == "_cz_p" else row.column(n) for n in names], names=names)

    for batch in batches:
        names = batch.schema.names
        sources, blocks, sizes, p, rows = (batch.column("_cz_" + c).to_pylist()
                                           for c in ("source_key", "block", "size", "p", "rows"))
        passed, out = np.ones(len(p), bool), []

        def close(x):
            if x[0] is not None:
                out.append(held(x[0], x[2]))
            else:
                passed[x[1]], p[x[1]] = True, x[2]

        def end():
            if keep == LANDING and open_:
                _land(open_, draw)
            for x in open_:
                close(x)
            open_.clear()

        for i in range(len(p)):
            if (sources[i], blocks[i]) != key:
                end()
                key = (sources[i], blocks[i])
                keep = LANDING if rows[i] <= BLOCK_ROWS else 2
                draw = np.random.RandomState(zlib.crc32(repr(key).encode()))
            if not _open(p[i]):
                p[i] = float(round(p[i]))
                continue
            passed[i] = False
            open_.append([None, i, p[i], float(sizes[i])])
            while len(open_) > keep:
                three = open_[:3]
                moved = _step([x[2] for x in three], _direction([x[3] for x in three]), draw.random_sample())
                for x, value in zip(three, moved):
                    x[2] = value if _open(value) else float(round(value))
                    if not _open(value):
                        close(x)
                open_[:] = [x for x in open_ if _open(x[2])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.float64()) if n == "_cz_p" else batch.column(n) for n in names],
            names=names).filter(pa.array(passed))
        yield from out
        for x in open_:
            if x[0] is None:
                x[0], x[1] = batch.take(pa.array([x[1]])), -1
    if open_:
        if keep == LANDING:
            _land(open_, draw)
        for x in open_:
            yield held(x[0], x[2])


def balanced_copies(docs: DataFrame, size: Column, source: str = "source", key: Sequence[str] = ("doc_id",),
                    weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``docs`` with ``_cz_size``, ``_cz_source_size``, ``_cz_target`` and ``_cz_copies``.

    ``size``: a document's tokens (null counts as 0). Every row is a unit of its own, also
    when rows or ids repeat or are null; the hash of ``key`` and size orders them, so reruns agree. A
    null source is a source like any other. A source of size 0 has target 0. Copies are 0 to
    ``ceil(most)``. An empty table gives an empty result.
    """
    spark, tables = docs.sparkSession, Tables()
    bounded_batches(spark)
    sized = docs.withColumn("_cz_size", F.coalesce(size, F.lit(0)).cast("bigint"))
    sized = written(sized.withColumn("_cz_hash", F.xxhash64(*[F.col(k) for k in key], "_cz_size")), "mix-sized", tables)
    per = written(source_targets(sized.select(F.col(source).alias("source"), F.col("_cz_size").alias("size")),
                                 weights, share, most), "mix-sources")
    per = per.select(
        F.col("source").alias("_cz_source"), F.xxhash64(F.coalesce("source", F.lit("\0null"))).alias("_cz_source_key"),
        F.col("source_size").alias("_cz_source_size"), F.col("target").alias("_cz_target"),
        F.col("source_rows").alias("_cz_rows"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("_cz_rate"))
    head = per.agg(F.count(F.lit(1)).alias("n"), F.max("_cz_rows").alias("rows")).first()
    rate = F.round("_cz_rate", 12)
    flow = (sized.join(broadcast_if_small(per, head["n"]), sized[source].eqNullSafe(per["_cz_source"]))
            .drop("_cz_source").withColumn("_cz_base", F.floor(rate)).withColumn("_cz_p", rate - F.floor(rate)))
    schema = StructType([*flow.schema.fields, StructField("_cz_block", LongType())])
    schema = StructType([StructField(f.name, DoubleType() if f.name == "_cz_p" else f.dataType) for f in schema])
    done, rows = [], head["rows"] or 0
    while True:
        # blocks of a source: of all rows first, then of the two that each block left
        block = F.pmod(F.xxhash64("_cz_hash", F.lit(len(done))), F.ceil(F.col("_cz_rows") / F.lit(BLOCK_ROWS)))
        last = rows <= BLOCK_ROWS
        dealt = (flow.withColumn("_cz_block", block.cast("bigint"))
                 .repartition("_cz_source_key", "_cz_block")
                 .sortWithinPartitions("_cz_source_key", "_cz_block", "_cz_hash", "_cz_size",
                                       *[F.col(k) for k in key]))
        walked = dealt.mapInArrow(_walk, schema)
        walked = written(walked, f"mix-walk{len(done)}")
        tables.drop(spark)
        if last:
            done.append(walked)
            break
        done.append(walked.where("_cz_p IN (0, 1)"))
        flow = (walked.where("_cz_p NOT IN (0, 1)").drop("_cz_block")
                .withColumn("_cz_rows", F.ceil(F.col("_cz_rows") / F.lit(BLOCK_ROWS)) * 2))
        rows = 2 * -(-rows // BLOCK_ROWS)
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x.select(out.columns))
    return out.withColumn("_cz_copies", (F.col("_cz_base") + F.col("_cz_p")).cast("bigint"))


def mix_table(docs: DataFrame) -> DataFrame:
    """Per document its size, its source's size and target, and the words that the mix takes."""
    narrow = docs.select("doc_id", "source", word_count().alias("size"))
    got = balanced_copies(narrow, F.col("size"))
    return got.select("doc_id", "size", F.col("_cz_source_size").alias("source_size"),
                      F.col("_cz_target").alias("target"), (F.col("size") * F.col("_cz_copies")).alias("taken"),
                      F.col("_cz_copies").alias("copies"), "source")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, columns as they were."""
    got = balanced_copies(docs, word_count())
    return (got.withColumn("_cz_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_cz_copies"))))
            .where("_cz_copies > 0").select(*docs.columns))
