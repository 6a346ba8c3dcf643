"""Approximate search with an inverted-file index (M8): coarse cells, then exact scoring
inside the cells a query probes.

* A cell belongs to a centre. Centres are *pivots* (:func:`hash_pivots`: the valid rows whose keys
  hash lowest, which any engine can recompute) or the centroids of ``pyspark.ml`` KMeans
  (:func:`train_cells`). ``n_cells x dim`` numbers, bounded by a parameter and by
  ``MAX_CENTER_BYTES``, are the only rows that reach the driver.
* Every valid index row goes to its nearest centre and every valid query to its ``nprobe``
  nearest ones: by cosine, rounded, ties by cell number, in score blocks of bounded size. Rows
  that exact search leaves out (null, short, zero, not finite) have no cell.
* Stored form: versions, like the index itself. :func:`write_cells` writes a base, the index
  partitioned by cell with the rows of each cell next to it. :func:`refresh_cells` adds what the
  index's deltas changed since then as a delta: the changed keys, and the rows they have now, by
  cell. :func:`read_cells` merges on read: a row counts if no later version changed its key, so
  a deleted key is never served. :func:`ivf_search_stored` reads only the folders of the probed
  cells.
* A search of stored cells sends the queries to the cells, not the index to the queries: they are
  broadcast with the lists of their cells and scored inside the scan of the cells' folders
  (:func:`_score_scan`). Queries beyond the broadcast's bytes go in hash blocks of that size, a scan
  each, so the index is neither shuffled nor copied and every query is answered.
* Without stored cells both sides are dealt by cell. One cell may hold a large share of the
  rows (copies are common). Cells are therefore cut into sub-blocks of at most ``index_block_rows`` rows, and the queries probing a cell into blocks of
  at most ``query_block_rows``; each (cell, index block, query block) group is scored exactly
  with the kernel of :mod:`cadenza.operators.knn`. No group grows with the data.
* Per query, partial top-k lists merge in a WindowGroupLimit, as in exact search.

Recall against exact search and the share of all (query, row) pairs scored are reported side by
side (:func:`ivf_recall`): recall alone says little when most pairs are scored anyway.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from cadenza.functions.vectors import finite_norm, has_dim, md5_hex_int, norm
from cadenza.llm.common import bounded_batches
from cadenza.operators import index as X
from cadenza.operators.knn import (DEFAULT_BROADCAST_BYTES, OUT_ROWS, PACK_ROWS, SCORE_CELLS, _Best, _candidates, _matrix,
                                   _reduce_topk, _scaled_round, _score_block, _topk_rows, _valid_rows)
from cadenza.session import scratch_path, shared_dir

MAX_CELLS = 65536
MAX_CENTER_BYTES = 256 << 20     # centres are broadcast
MAX_CHANGED_KEYS = 500_000       # changed keys of deltas that are broadcast; more are joined by a shuffle
DIGITS = 6                       # of the cosine that routes a row
PRUNE_SLACK = 1e-5               # of bounds that rule a cell out: more than scores are rounded by
CELL_FILE_ROWS = 500_000         # rows of a file of a cell, about
SCAN_QUERIES = 1 << 14           # queries of a cell whose vectors are laid side by side at once


@dataclass(frozen=True)
class Cells:
    """Unit centres, ``n_cells x dim``; cell number = row."""

    centers: np.ndarray

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, c.tolist()) for i, c in enumerate(self.centers)]
        spark.createDataFrame(rows, "cell int, center array<double>").write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Cells":
        rows = spark.read.parquet(path).orderBy("cell").limit(MAX_CELLS).collect()
        return Cells(np.array([r["center"] for r in rows], dtype=np.float64))


def _bounded(n_cells: int, dim: int) -> None:
    if not 0 < n_cells <= MAX_CELLS or n_cells * dim * 8 > MAX_CENTER_BYTES:
        raise ValueError(f"n_cells must be in 1..{MAX_CELLS} and the centres below {MAX_CENTER_BYTES} bytes")


def _unit(rows) -> Cells:
    if not len(rows):
        return Cells(np.empty((0, 0)))
    centers = np.array([np.asarray(c, dtype=np.float64) for c in rows])
    return Cells(centers / np.sqrt((centers * centers).sum(axis=1, keepdims=True)))


def _valid(index: DataFrame, vec: str, dim: int) -> DataFrame:
    n = norm(vec)
    return index.where(has_dim(vec, dim) & (n > 0) & finite_norm(n))


def hash_pivots(index: DataFrame, vec: str, dim: int, n_cells: int, key: str) -> Cells:
    """The ``n_cells`` valid rows whose keys have the lowest hash (ties by key) as centres."""
    _bounded(n_cells, dim)
    order = [md5_hex_int(F.col(key).cast("string"), 1, 8), F.col(key)]
    rows = _valid(index, vec, dim).orderBy(*order).limit(n_cells).select(vec).collect()
    return _unit([r[0] for r in rows])


def train_cells(index: DataFrame, vec: str, dim: int, n_cells: int, seed: int = 42,
                sample_fraction: float | None = None, key: str | None = None,
                max_iter: int = 10) -> Cells:
    """KMeans (cosine) over the index's vectors, on a hash sample of the keys when
    ``sample_fraction`` is given (every row is still indexed and searched).

    KMeans reads its input once per iteration: the training vectors are written once to the
    shared checkpoint folder first, so the iterations read them back instead of recomputing
    them, and a lost executor does not send the training back to the source.
    """
    _bounded(n_cells, dim)
    rows = _valid(index, vec, dim)
    if sample_fraction is not None and key is not None:
        rows = rows.where(md5_hex_int(F.col(key).cast("string"), 1, 8) < int(round(sample_fraction * (1 << 32))))
    shared_dir(index.sparkSession)
    train = rows.select(array_to_vector(vec).alias("features")).checkpoint(eager=True)
    return _unit(KMeans(k=n_cells, seed=seed, maxIter=max_iter, initSteps=1,
                        distanceMeasure="cosine").fit(train).clusterCenters())


def _route(rows: DataFrame, vec: str, nrm: str, cells: Cells, dim: int, nprobe: int, lists: bool = False) -> DataFrame:
    """One row per (valid row, one of its ``nprobe`` nearest cells): the columns plus ``cell``; with
    ``lists`` one per valid row, the columns plus ``cells``."""
    bounded_batches(rows.sparkSession)
    shipped = rows.sparkSession.sparkContext.broadcast(cells.centers)
    added = StructField("cells", ArrayType(IntegerType())) if lists else StructField("cell", IntegerType())
    schema = StructType(rows.schema.fields + [added])
    arrow_schema = to_arrow_schema(schema)
    n_cells = len(cells.centers)
    probes, step = min(nprobe, n_cells), max(1, SCORE_CELLS // max(n_cells, 1))

    def route(batches):
        centers = shipped.value
        for b in batches:
            t = _valid_rows(pa.Table.from_batches([b]), vec, nrm, dim, "cosine")
            for lo in range(0, t.num_rows, step):
                part = t.slice(lo, step)
                x = _matrix(part.column(vec), dim)
                s = (x @ centers.T) / part.column(nrm).to_numpy(zero_copy_only=False)[:, None]
                row, cell = _topk_rows(_scaled_round(s, DIGITS), np.arange(n_cells), probes, None)
                found = pa.array(cell.astype(np.int32))
                if lists:                                   # every row has as many
                    ends = np.arange(0, len(found) + 1, probes, dtype=np.int32)
                    out = part.append_column("cells", pa.ListArray.from_arrays(pa.array(ends), found))
                else:
                    out = part.take(pa.array(row)).append_column("cell", found)
                yield from out.cast(arrow_schema).to_batches()

    return rows.mapInArrow(route, schema)


def _queries(queries: DataFrame, query_key: str, query_vec: str, query_payload: Sequence[str] = (),
             query_norm: str | None = None) -> DataFrame:
    n = F.col(query_norm) if query_norm else norm(query_vec)
    return queries.select(F.col(query_key).alias("_qk"), F.col(query_vec).alias("_qv"),
                          n.cast("double").alias("_qn"),
                          *[F.col(c).alias(f"_qp{i}") for i, c in enumerate(query_payload)])


def _index_rows(index: DataFrame, index_key: str, index_vec: str, payload: Sequence[str],
                index_norm: str | None = None, cell: bool = False) -> DataFrame:
    n = F.col(index_norm) if index_norm else norm(index_vec)
    return index.select(F.col(index_key).alias("_ik"), F.col(index_vec).alias("_iv"),
                        n.cast("double").alias("_in"), *(["cell"] if cell else []), *payload)


def _score_cells(routed: DataFrame, x: DataFrame, n_cells: int, probes: int, *, dim: int, k: int,
                 query_key: str, index_key: str, payload: Sequence[str], exclude_self: bool,
                 digits: int, query_block_rows: int, index_block_rows: int, xc: dict[int, int],
                 query_payload: Sequence[str] = ()) -> tuple[DataFrame, float]:
    """Exact top-k inside the probed cells, in bounded (cell, index block, query block) groups.
    ``xc``: index rows of every cell, probed or not."""
    qc = dict(routed.groupBy("cell").count().collect())
    nq = sum(qc.values()) // probes                         # each query is routed to that many cells
    nx = sum(xc.values())
    pairs = sum(qc.get(c, 0) * xc.get(c, 0) for c in range(n_cells))
    share = pairs / (nq * nx) if nq and nx else 0.0
    sizes = F.broadcast(x.sparkSession.createDataFrame(
        [(c, max(1, math.ceil(xc.get(c, 0) / index_block_rows)), max(1, math.ceil(qc.get(c, 0) / query_block_rows)))
         for c in range(n_cells)], "cell int, isub bigint, qsub bigint"))       # a row per cell

    def blocks(n: str):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    xrep = x.join(sizes, "cell").withColumn("ib", F.pmod(F.xxhash64("_ik"), "isub")).withColumn("qb", blocks("qsub"))
    qrep = routed.join(sizes, "cell").withColumn("qb", F.pmod(F.xxhash64("_qk"), "qsub")).withColumn("ib", blocks("isub"))
    xrep, qrep = xrep.drop("isub", "qsub"), qrep.drop("isub", "qsub")

    schema = _found_schema(routed.schema, x.schema, query_key, query_payload, index_key, payload)
    arrow_schema = to_arrow_schema(schema)
    payload = list(payload)
    qp_names = ["_qk"] + [f"_qp{i}" for i in range(len(query_payload))]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        right = _valid_rows(right, "_iv", "_in", dim, "cosine")
        if left.num_rows == 0 or right.num_rows == 0:
            return arrow_schema.empty_table()
        qcols = {c: left.column(c).combine_chunks() for c in qp_names}
        Q = _matrix(left.column("_qv"), dim)
        qn = left.column("_qn").to_numpy().astype(np.float64)
        qkeys, best = qcols["_qk"].to_numpy(zero_copy_only=False), _Best(len(Q), k)
        for lo in range(0, right.num_rows, PACK_ROWS):      # a part of the group is dense at once
            part = right.slice(lo, PACK_ROWS)
            ikeys = part.column("_ik").combine_chunks()
            hits = _score_block(Q, qn, qkeys, _matrix(part.column("_iv"), dim), part.column("_in").to_numpy().astype(np.float64),
                                ikeys, k, digits, "cosine", exclude_self, best.floor)
            best.add(*hits, {"_ik": ikeys, **{c: part.column(c).combine_chunks() for c in payload}})
        found = best.table()
        if found is None:
            return arrow_schema.empty_table()
        cand = _candidates(qcols, found.column("_q").to_numpy(), found.column("_ik").combine_chunks(),
                           {c: found.column(c).combine_chunks() for c in payload}, np.arange(found.num_rows),
                           found.column("score").to_numpy(), digits, arrow_schema)
        return _reduce_topk(cand, query_key, index_key, k)

    partial = (qrep.groupBy("cell", "ib", "qb").cogroup(xrep.groupBy("cell", "ib", "qb"))
               .applyInArrow(score, schema))
    return _ranked(partial, k, query_key, query_payload, index_key, payload), share


def _score_scan(asked: pa.Table, x: DataFrame, out: StructType, *, n_cells: int, dim: int, k: int, index_key: str,
                payload: Sequence[str], exclude_self: bool, digits: int, n_query_payload: int):
    """Partial top-k lists from one scan of the cells' rows, and their broadcast: every batch meets the
    queries of its cells (``asked``: queries with their ``cells``); the index is neither shuffled nor copied."""
    names = ["_qk"] + [f"_qp{i}" for i in range(n_query_payload)]
    lists = asked.column("cells").combine_chunks()
    cell, query = lists.flatten().to_numpy(), pc.list_parent_indices(lists).to_numpy()
    order = np.argsort(cell, kind="stable")
    starts = np.searchsorted(cell[order], np.arange(n_cells + 1))
    shipped = x.sparkSession.sparkContext.broadcast((
        query[order].astype(np.int32), starts, {c: asked.column(c).combine_chunks() for c in names},
        _matrix(asked.column("_qv"), dim), asked.column("_qn").to_numpy().astype(np.float64)))
    arrow_schema = to_arrow_schema(out)
    payload = list(payload)

    def score(batches):
        query, starts, qcols, Q, qn = shipped.value
        keys = qcols["_qk"].to_numpy(zero_copy_only=False)
        best = _Best(len(Q), k)
        for batch in batches:
            table = _valid_rows(pa.Table.from_batches([batch]), "_iv", "_in", dim, "cosine")
            of = table.column("cell").to_numpy()
            for c in np.unique(of).tolist():
                part = table.filter(pa.array(of == c))
                ikeys = part.column("_ik").combine_chunks()
                rows = {"_ik": ikeys, **{p: part.column(p).combine_chunks() for p in payload}}
                X, xn = _matrix(part.column("_iv"), dim), part.column("_in").to_numpy().astype(np.float64)
                for lo in range(starts[c], starts[c + 1], SCAN_QUERIES):
                    at = query[lo:min(lo + SCAN_QUERIES, starts[c + 1])]
                    qi, xi, si = _score_block(Q[at], qn[at], keys[at], X, xn, ikeys, k, digits, "cosine", exclude_self,
                                              best.floor[at])
                    best.add(at[qi], xi, si, rows)
        found = best.table()
        if found is not None:
            own = {c: found.column(c).combine_chunks() for c in ("_ik", *payload)}
            for lo in range(0, found.num_rows, OUT_ROWS):
                at = slice(lo, lo + OUT_ROWS)
                rows = np.arange(lo, min(lo + OUT_ROWS, found.num_rows))
                yield from _candidates(qcols, found.column("_q").to_numpy()[at], own["_ik"], {c: own[c] for c in payload}, rows,
                                       found.column("score").to_numpy()[at], digits, arrow_schema).to_batches()

    return x.mapInArrow(score, out), shipped


def _found_schema(routed: StructType, x: StructType, query_key: str, query_payload: Sequence[str], index_key: str,
                  payload: Sequence[str]) -> StructType:
    qf, xf = {f.name: f for f in routed.fields}, {f.name: f for f in x.fields}
    return StructType([StructField(query_key, qf["_qk"].dataType)]
                      + [StructField(c, qf[f"_qp{i}"].dataType) for i, c in enumerate(query_payload)]
                      + [StructField(index_key, xf["_ik"].dataType)]
                      + [StructField(c, xf[c].dataType) for c in payload] + [StructField("score", DoubleType())])


def _ranked(partial: DataFrame, k: int, query_key: str, query_payload: Sequence[str], index_key: str,
            payload: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(query_key).orderBy(F.desc("score"), F.asc(index_key))
    top = partial.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.select(query_key, *query_payload, "rank", index_key, *payload, "score")


def ivf_search(queries: DataFrame, index: DataFrame, model: Cells, *, dim: int, k: int = 10,
               nprobe: int = 1, query_key: str = "query_id", query_vec: str = "query_vec",
               index_key: str = "link", index_vec: str = "emotions_embeddings",
               payload: Sequence[str] = (), exclude_self: bool = False, digits: int = 6,
               query_block_rows: int = 4096, index_block_rows: int = 32768) -> tuple[DataFrame, float]:
    """Approximate top ``k`` per query (same output as exact search without query payload),
    and the share of (query, row) pairs scored. Cells are assigned here; see
    :func:`ivf_search_stored` for an index already written by cell."""
    if query_key == index_key:
        raise ValueError("output column names of the two sides must differ")
    n_cells = len(model.centers)
    routed = _route(_queries(queries, query_key, query_vec), "_qv", "_qn", model, dim, nprobe)
    x = _route(_index_rows(index, index_key, index_vec, payload), "_iv", "_in", model, dim, 1)
    # cell counts, then copies: save both computed sides once
    shared_dir(queries.sparkSession)
    routed, x = routed.checkpoint(eager=True), x.checkpoint(eager=True)
    return _score_cells(routed, x, n_cells, min(nprobe, n_cells), dim=dim, k=k,
                        query_key=query_key, index_key=index_key, payload=payload,
                        exclude_self=exclude_self, digits=digits, query_block_rows=query_block_rows,
                        index_block_rows=index_block_rows, xc=dict(x.groupBy("cell").count().collect()))


def _versions(path: str) -> str:
    return f"{path.rstrip('/')}-versions"


def _write_cell_version(rows: DataFrame, model: Cells, path: str, kind: str, source: str | None, covers: int, *, dim: int,
                        index_key: str, index_vec: str, payload: Sequence[str], changed: DataFrame | None = None) -> None:
    """One version beside ``path``: rows by cell (the first base's lie in ``path`` itself), rows of
    every cell (``counts``) and, for a delta, the changed keys (``keys``). Its metadata, written
    last, makes it visible."""
    spark, root = rows.sparkSession, _versions(path)
    version = X._next_version(spark, root, source)
    at = X.version_path(root, version)
    data = path.rstrip("/") if version == 1 else f"{at}/data"
    index_norm = "norm" if "norm" in rows.columns else None
    routed = _route(_index_rows(rows, index_key, index_vec, payload, index_norm), "_iv", "_in", model, dim, 1)
    parts = max(1, len(model.centers))
    salt = F.pmod(F.xxhash64("_ik"), F.lit(1 + rows.count() // (parts * CELL_FILE_ROWS)))
    out = routed.repartition("cell", salt).select(F.col("_ik").alias(index_key), F.col("_iv").alias(index_vec),
                                                  *([F.col("_in").alias("norm")] if index_norm else []), *payload, "cell")
    out.write.mode("overwrite").partitionBy("cell").parquet(data)
    counts = spark.read.schema(out.schema).parquet(data).groupBy("cell").count()
    counts.write.mode("overwrite").parquet(f"{at}/counts")
    meta = {"kind": kind, "source": source, "covers": covers, "data": data, "schema": out.schema.json()}
    if changed is not None:
        changed.select(index_key).distinct().write.mode("overwrite").parquet(f"{at}/keys")
        meta["n_keys"] = spark.read.parquet(f"{at}/keys").count()
    X._write_meta(spark, at, meta)


def write_cells(index: DataFrame, model: Cells, path: str, *, dim: int, index_key: str = "link",
                index_vec: str = "emotions_embeddings", payload: Sequence[str] = (), covers: int = 0) -> str:
    """Store the index as a base of inverted lists: one folder per cell, and the rows of every cell
    beside them. Rows are dealt by cell first (large cells to several tasks), so a cell has few
    files. ``covers``: the index version that these rows are."""
    _write_cell_version(index, model, path, X.BASE, None, covers, dim=dim, index_key=index_key, index_vec=index_vec, payload=payload)
    return path


def cell_versions(spark: SparkSession, path: str) -> dict[int, dict]:
    """The newest base of the inverted file and the deltas after it."""
    versions = X.list_versions(spark, _versions(path))
    start = max((v for v, m in versions.items() if m["kind"] == X.BASE), default=0)
    return {v: m for v, m in versions.items() if v >= start}


def refresh_cells(spark: SparkSession, index_base: str, model: Cells, path: str, *, dim: int, index_key: str = "link",
                  index_vec: str = "emotions_embeddings", payload: Sequence[str] = ()) -> int:
    """Bring the inverted file up to the index's newest version; returns the version it covers.

    What later versions of the index touched is written as one delta: those keys, and the rows they
    have in the merged index. The rows that did not change are not read by cell again. Where the
    index was compacted meanwhile, so its deltas may be gone, a new base is written. A retry
    rewrites its own version.
    """
    have, own = X.list_versions(spark, index_base), cell_versions(spark, path)
    covered, newest = max((m["covers"] for m in own.values()), default=0), max(have, default=0)
    later = [v for v in have if v > covered]
    if not later:
        return covered
    source, kw = f"index-{newest}", {"dim": dim, "index_key": index_key, "index_vec": index_vec, "payload": payload}
    index = X.read_index(spark, index_base)
    if not own or any(have[v]["kind"] == X.BASE for v in later):
        _write_cell_version(index, model, path, X.BASE, source, newest, **kw)
        return newest
    changed = None
    for v in later:
        keys = X._read_version(spark, index_base, v).select(index_key)
        changed = keys if changed is None else changed.unionByName(keys)
    rows = index.join(changed.distinct(), index_key, "left_semi")
    _write_cell_version(rows, model, path, X.DELTA, source, newest, changed=changed, **kw)
    return newest


def read_cells(spark: SparkSession, path: str, cells: Sequence[int] | None = None, index_key: str = "link") -> DataFrame:
    """The live rows of the inverted file, of the given cells only: those whose key no later version
    changed. The base's rows meet the changed keys of the deltas, never other rows."""
    own = cell_versions(spark, path)
    if not own:
        raise FileNotFoundError(f"no inverted file under {path}")
    rows = changed = None
    for v, meta in own.items():
        schema = StructType.fromJson(json.loads(meta["schema"]))
        part = spark.read.schema(schema).parquet(meta["data"]).withColumn("_version", F.lit(v))
        rows = part if rows is None else rows.unionByName(part)
        if meta["kind"] == X.DELTA:
            keys = spark.read.parquet(f"{X.version_path(_versions(path), v)}/keys").withColumn("_changed", F.lit(v))
            changed = keys if changed is None else changed.unionByName(keys)
    if cells is not None:
        rows = rows.where(F.col("cell").isin(list(cells)))
    if changed is None:
        return rows.drop("_version")
    last = changed.groupBy(index_key).agg(F.max("_changed").alias("_changed"))
    if sum(m.get("n_keys", 0) for m in own.values()) <= MAX_CHANGED_KEYS:
        last = F.broadcast(last)
    live = rows.join(last, index_key, "left").where(F.col("_changed").isNull() | (F.col("_changed") <= F.col("_version")))
    return live.drop("_version", "_changed")


def _cell_rows(spark: SparkSession, path: str) -> dict[int, int]:
    """Rows of every cell over all versions (rows that a later version changed included)."""
    total: dict[int, int] = {}
    for v in cell_versions(spark, path):
        for r in spark.read.schema("cell int, count bigint").parquet(f"{X.version_path(_versions(path), v)}/counts").collect():   # <= n_cells
            total[r["cell"]] = total.get(r["cell"], 0) + r["count"]
    return total


def ivf_search_stored(queries: DataFrame, path: str, model: Cells, *, dim: int, k: int = 10,
                      nprobe: int = 1, query_key: str = "query_id", query_vec: str = "query_vec",
                      index_key: str = "link", index_vec: str = "emotions_embeddings",
                      payload: Sequence[str] = (), query_payload: Sequence[str] = (),
                      query_norm: str | None = None, exclude_self: bool = False, digits: int = 6,
                      max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, float]:
    """:func:`ivf_search` over an index written by :func:`write_cells`: only the folders of the
    probed cells are read (partition pruning), so a search reads about ``nprobe / n_cells`` of
    the index instead of all of it, once per ``max_broadcast_bytes`` of queries."""
    if query_key == index_key:
        raise ValueError("output column names of the two sides must differ")
    spark, n_cells = queries.sparkSession, len(model.centers)
    held = scratch_path(spark, "ivf-queries")
    routed = _route(_queries(queries, query_key, query_vec, query_payload, query_norm), "_qv", "_qn", model, dim, nprobe, lists=True)
    routed.write.parquet(held)
    routed = spark.read.schema(routed.schema).parquet(held)
    counts = _cell_rows(spark, path)
    asked = dict(routed.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect())   # <= n_cells
    n_queries = routed.count()
    whole = n_queries * sum(counts.values())
    share = sum(n * counts.get(c, 0) for c, n in asked.items()) / whole if whole else 0.0
    stored = read_cells(spark, path, sorted(asked), index_key)
    x = _index_rows(stored, index_key, index_vec, payload, "norm" if "norm" in stored.columns else None, cell=True)
    out = _found_schema(routed.schema, x.schema, query_key, query_payload, index_key, payload)

    def answers(part: DataFrame):
        partial, shipped = _score_scan(part.toArrow(), x, out, n_cells=n_cells, dim=dim, k=k, index_key=index_key, payload=payload,
                                       exclude_self=exclude_self, digits=digits, n_query_payload=len(query_payload))
        return _ranked(partial, k, query_key, query_payload, index_key, payload), shipped

    blocks = math.ceil(n_queries * (8 * dim + 8 * min(nprobe, n_cells) + 64) / max_broadcast_bytes)
    if blocks <= 1:
        return answers(routed)[0], share
    found = scratch_path(spark, "ivf-answers")
    for b in range(blocks):
        hits, shipped = answers(routed.where(F.pmod(F.xxhash64("_qk"), F.lit(blocks)) == b))
        hits.write.mode("append").parquet(found)
        shipped.destroy()
    return spark.read.schema(hits.schema).parquet(found), share


def _bounded_cells(queries: DataFrame, model: Cells, bounds: dict[int, tuple[float, float]], dim: int, done: int) -> DataFrame:
    """The (query, cell) pairs beyond the query's ``done`` nearest cells whose cell may hold a row as
    good as the query's worst kept score ``_kth`` (null: fewer than k found, so every cell may).

    For unit vectors ``|d(q, p) - d(x, p)| <= d(q, x)``, so a cell whose rows lie between ``lo`` and
    ``hi`` of its pivot p holds nothing nearer than ``max(d(q, p) - hi, lo - d(q, p), 0)``. The slack
    covers the rounding of scores and of distances.
    """
    lo = np.array([bounds.get(c, (np.inf, np.inf))[0] for c in range(len(model.centers))])
    hi = np.array([bounds.get(c, (np.inf, -np.inf))[1] for c in range(len(model.centers))])
    shipped = queries.sparkSession.sparkContext.broadcast((model.centers, lo, hi))
    schema = StructType(queries.schema.fields + [StructField("cell", IntegerType())])
    arrow_schema = to_arrow_schema(schema)
    step = max(1, SCORE_CELLS // max(len(model.centers), 1))

    def route(batches):
        centers, lo, hi = shipped.value
        for b in batches:
            table = _valid_rows(pa.Table.from_batches([b]), "_qv", "_qn", dim, "cosine")
            for at in range(0, table.num_rows, step):
                t = table.slice(at, step)
                s = (_matrix(t.column("_qv"), dim) @ centers.T) / t.column("_qn").to_numpy()[:, None]
                rank = np.argsort(np.argsort(-_scaled_round(s, DIGITS), axis=1, kind="stable"), axis=1)
                far = np.sqrt(np.maximum(2.0 - 2.0 * s, 0.0))
                least = np.maximum(np.maximum(far - hi[None, :], lo[None, :] - far), 0.0)
                kth = pc.fill_null(t.column("_kth"), -2.0).to_numpy()
                reach = np.sqrt(np.maximum(2.0 - 2.0 * kth, 0.0) + PRUNE_SLACK)
                row, cell = np.nonzero((rank >= done) & np.isfinite(hi)[None, :] & (least <= reach[:, None] + PRUNE_SLACK))
                out = t.take(pa.array(row)).append_column("cell", pa.array(cell.astype(np.int32)))
                yield from out.cast(arrow_schema).to_batches()

    return queries.mapInArrow(route, schema)


def cell_bounds(rows: DataFrame, model: Cells, dim: int, vec: str = "_iv", nrm: str = "_in") -> dict[int, tuple[float, float]]:
    """The least and largest distance of a cell's unit vectors from its pivot: a row per cell."""
    shipped = rows.sparkSession.sparkContext.broadcast(model.centers)

    def measure(batches):
        centers = shipped.value
        for b in batches:
            t = _valid_rows(pa.Table.from_batches([b]), vec, nrm, dim, "cosine")
            cell = t.column("cell").to_numpy()
            s = np.einsum("ij,ij->i", _matrix(t.column(vec), dim), centers[cell]) / t.column(nrm).to_numpy()
            far = np.sqrt(np.maximum(2.0 - 2.0 * s, 0.0))
            for c in np.unique(cell).tolist():
                own = far[cell == c]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([own.min()]), pa.array([own.max()])],
                                                 names=["cell", "lo", "hi"])

    found = rows.select(vec, nrm, "cell").mapInArrow(measure, "cell int, lo double, hi double")
    return {r["cell"]: (r["lo"], r["hi"]) for r in found.groupBy("cell").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()}


def pruned_search(queries: DataFrame, path: str, model: Cells, *, dim: int, k: int = 10, first: int = 2,
                  query_key: str = "query_id", query_vec: str = "query_vec", index_key: str = "link",
                  index_vec: str = "emotions_embeddings", payload: Sequence[str] = (), exclude_self: bool = False,
                  digits: int = 6) -> tuple[DataFrame, float]:
    """Exact top ``k`` from an inverted file, and the share of (query, row) pairs that were scored.

    The ``first`` nearest cells of a query give its k-th best score so far; of the others only those
    are read that the triangle inequality does not rule out (:func:`_bounded_cells`). The answers
    are those of exact search, whatever the data; how much is skipped depends on how well the
    cells separate them.
    """
    spark, n_cells = queries.sparkSession, len(model.centers)
    first = min(first, n_cells)
    q = _queries(queries, query_key, query_vec)
    kw = {"dim": dim, "k": k, "query_key": query_key, "index_key": index_key, "payload": payload, "exclude_self": exclude_self,
          "digits": digits, "query_block_rows": 4096, "index_block_rows": 32768}
    shared_dir(spark)
    near = _route(q, "_qv", "_qn", model, dim, first).checkpoint(eager=True)
    counts = _cell_rows(spark, path)
    stored = read_cells(spark, path, None, index_key)
    x = _index_rows(stored, index_key, index_vec, payload, "norm" if "norm" in stored.columns else None, cell=True)
    bounds = cell_bounds(x, model, dim)
    begun, share = _score_cells(near, x, n_cells, first, xc=counts, **kw)
    begun = begun.checkpoint(eager=True)
    kth = begun.where(F.col("rank") == k).select(F.col(query_key).alias("_qk"), F.col("score").alias("_kth"))
    rest = _bounded_cells(q.join(kth, "_qk", "left"), model, bounds, dim, first).drop("_kth").checkpoint(eager=True)
    probed = sorted(r["cell"] for r in rest.select("cell").distinct().collect())                 # <= n_cells
    more, _ = _score_cells(rest, x.where(F.col("cell").isin(probed)), n_cells, 1, xc=counts, **kw)
    found = begun.drop("rank").unionByName(more.drop("rank"))
    sizes = rest.groupBy("cell").count().collect()                                               # <= n_cells
    pairs = sum(r["count"] * counts.get(r["cell"], 0) for r in sizes)
    whole = near.count() // first * sum(counts.values())
    return _ranked(found, k, query_key, (), index_key, payload), share + (pairs / whole if whole else 0.0)


def ivf_recall(exact: DataFrame, approx: DataFrame, query_key: str, index_key: str) -> DataFrame:
    """recall@k: the share of exact (query, row) answers the approximate search also returns."""
    e = exact.select(query_key, index_key)
    hit = e.join(approx.select(query_key, index_key).withColumn("_hit", F.lit(1)),
                 [query_key, index_key], "left")
    return hit.agg((F.count("_hit") / F.count(F.lit(1))).alias("recall"))
