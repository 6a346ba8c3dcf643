"""Exact top-k similarity search (J2, F16, L3): many queries against a vector index.

Spark has no matrix-product top-k operator, so scoring runs in numpy inside Arrow-batched
tasks, and everything around it is a DataFrame plan:

* **Broadcast path** (query matrix under ``max_broadcast_bytes``): the queries are fetched
  once with a row cap derived from the byte budget, broadcast, and every index partition is
  scored batch by batch in ``mapInArrow``. Each task keeps only a running top-k per query, so
  the index is read once and never shuffled, and no pair is ever materialized as a row.
* **Block path** (larger query sets): the queries are written once, by hash into blocks of
  that budget. The index stays where it is: the blocks that ``PASS_BYTES`` hold are broadcast and
  scored in one scan of it, and each pass writes its answers. So the index is never copied,
  shuffled or checkpointed, and is read once per ``PASS_BYTES`` of queries.
* **Few vectors** (``few_vectors``, given for embeddings of labels): the index is reduced to its
  distinct vectors with the ``k`` smallest keys of each, which alone can be answers, and that table is
  broadcast if it fits. Queries are scored in their own tasks; the pairs scored are queries by
  distinct vectors, not by rows.

All paths end in the same merge: ``row_number() over (partition by query order by score
desc, key)`` with ``rank <= k``, which Spark plans as a WindowGroupLimit (partial top-k before
the shuffle, final after).

Scores are ``dot / (|q| |x|)`` (cosine, the default), ``dot``, or minus the Euclidean distance
(``l2``), in double, rounded half away from zero to ``digits``; ties go by index key. That
ordering is total, so partial top-k lists merge exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StructField, StructType

from cadenza.functions.vectors import finite_norm, has_dim, norm, sparse_norm
from cadenza.llm.common import bounded_batches
from cadenza.session import scratch_path

DEFAULT_BROADCAST_BYTES = 64 << 20   # query matrix bytes allowed in a broadcast
SCORE_CELLS = 4_000_000              # score-matrix cells computed at once per task
TILE_CELLS = 1 << 20                 # of a search's product: what selects from it stays in the cache
PASS_BYTES = 64 << 20                # bytes of the query blocks that one pass over the index answers
SINGLE_SHARE = 16                    # a tile's pairs over those that a product in single precision may leave to be scored
BOUND_GROUPS = 64                    # groups of columns whose maxima bound a query's k-th best
OUT_ROWS = 1 << 16                   # rows of an answer batch
PACK_ROWS = 2048                     # vectors that are dense at once beside a packed table
FEW_QUERIES = 64                     # so many are answered by a scan of the index in any case
NO_FLOOR = np.iinfo(np.int64).min    # of a query with fewer than k answers so far


# ----------------------------------------------------------------------------- kernel

def _scaled_round(s: np.ndarray, digits: int) -> np.ndarray:
    """``round(s * 10^d)`` with halves away from zero, as int64 (the same double ops as SQL)."""
    y = s * float(10 ** digits)
    return (np.sign(y) * np.floor(np.abs(y) + 0.5)).astype(np.int64)


def _key_rank(keys: pa.Array) -> np.ndarray:
    order = pc.sort_indices(keys).to_numpy()
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order), dtype=np.int64)
    return rank


def _topk_rows(si: np.ndarray, key_rank: np.ndarray, k: int, mask: np.ndarray | None):
    """Per row of ``si`` (queries x candidates): the k best columns by (score desc, key asc).

    Returns flat (row, column) index arrays, best first within each row.
    """
    nq, nb = si.shape
    kk = min(k, nb)
    if nq == 0 or kk == 0:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty
    lo = int(si.min())
    span = int(si.max()) - lo + 1
    if span * nb < (1 << 62):
        comp = (si - lo) * nb + (nb - 1 - key_rank)[None, :]
        if mask is not None:
            comp[mask] = -1
        if kk < nb:
            idx = np.argpartition(-comp, kk - 1, axis=1)[:, :kk]
        else:
            idx = np.broadcast_to(np.arange(nb), (nq, nb)).copy()
        sel = np.take_along_axis(comp, idx, axis=1)
        order = np.argsort(-sel, axis=1, kind="stable")
        idx = np.take_along_axis(idx, order, axis=1)
        sel = np.take_along_axis(sel, order, axis=1)
        keep = (sel >= 0).ravel()
    else:  # very wide score range (dot metric on large vectors): one sort of all cells
        valid = np.ones((nq, nb), dtype=bool) if mask is None else ~mask
        row, col = np.nonzero(valid)
        order = np.lexsort((key_rank[col], -si[row, col], row))
        row, col = row[order], col[order]
        first = np.searchsorted(row, np.arange(nq))
        best = np.arange(len(row)) - first[row] < kk
        return row[best], col[best]
    qi = np.repeat(np.arange(nq, dtype=np.int64), kk)[keep]
    xi = idx.ravel()[keep]
    return qi, xi


def _kth_bound(w: np.ndarray, k: int) -> np.ndarray:
    """Per row of ``w`` a value that at least ``k`` columns reach (minus infinity if there are fewer):
    the k-th largest of the maxima of disjoint groups of columns, or of all columns if they are few."""
    nb = w.shape[1]
    if nb < k:
        return np.full(len(w), -np.inf)
    groups = max(BOUND_GROUPS, 2 * k)
    if nb >= 4 * groups:
        size = nb // groups
        w = w[:, :groups * size].reshape(len(w), groups, size).max(axis=2)
    return np.partition(w, w.shape[1] - k, axis=1)[:, w.shape[1] - k]


def _distances(q: np.ndarray, X: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Euclidean distances of the pairs, from the differences."""
    out = np.empty(len(row))
    for lo in range(0, len(row), 1 << 15):
        diff = q[row[lo:lo + (1 << 15)]] - X[col[lo:lo + (1 << 15)]]
        out[lo:lo + (1 << 15)] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    return out


def _pair_dots(q: np.ndarray, X: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Dot products of the pairs, in double."""
    out = np.empty(len(row))
    for lo in range(0, len(row), 1 << 15):
        at = slice(lo, lo + (1 << 15))
        out[at] = np.einsum("ij,ij->i", q[row[at]], X[col[at]])
    return out


def _set_at(near: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` of a table of few true values: eight are looked at as one."""
    flat = near.ravel()
    if flat.size % 8:
        return np.flatnonzero(flat)
    at = (np.flatnonzero(flat.view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return at[flat[at]]


class _Single:
    """Selects pairs of a block by a product in single precision, which takes a fraction of the time of
    one in double and of all that goes over its result.

    Both sides are scaled to a size of about one (``l2``: from the block's mean, so that digits are
    not lost by a common part). ``error`` bounds what a sum of ``dim`` such products is off by, so no
    answer is left out, whatever the vectors; the pairs that are left are scored in double."""

    def __init__(self, X: np.ndarray, xn: np.ndarray, metric: str):
        self.metric, self.dim = metric, X.shape[1]
        self.error = (self.dim + 16) * float(np.finfo(np.float32).eps)
        if metric == "l2":
            self.mean = X.mean(axis=0)
            self.x = X - self.mean
            self.most = float(np.einsum("ij,ij->i", X, X).max())
        else:
            self.x = X / xn[:, None] if metric == "cosine" else X
        self.xx = np.einsum("ij,ij->i", self.x, self.x)
        self.size = float(np.sqrt(self.xx.max()))
        self.usable = 1e-100 < self.size < 1e100
        if self.usable and metric != "l2":
            self.x32 = (self.x / self.size).astype(np.float32)

    def near(self, q: np.ndarray, n: np.ndarray, known: np.ndarray | None, k: int, unit: float) -> np.ndarray | None:
        """The pairs (queries x rows) that may be answers; nothing if that cannot be told."""
        some = known is None or (known == NO_FLOOR).any()
        if self.metric == "l2":
            own = q - self.mean
            qq = np.einsum("ij,ij->i", own, own)
            size = max(self.size, float(np.sqrt(qq.max())))
            if not 1e-100 < size < 1e100:
                return None
            left = np.column_stack((own / size, np.ones(len(q)))).astype(np.float32)
            right = np.column_stack((2.0 * self.x / size, -self.xx / size ** 2)).astype(np.float32)
            w = left @ right.T
            lost = 8 * (self.dim + 4) * np.finfo(float).eps * (np.einsum("ij,ij->i", q, q) + self.most)
            error = 4 * self.error * size ** 2 + lost
            low = _kth_bound(w, k).astype(float) * size ** 2 if some else np.full(len(q), -np.inf)
            far = np.sqrt(np.maximum(qq - low, 0.0) + error) + 1.5 * unit
            if known is not None:
                far = np.minimum(far, np.where(known == NO_FLOOR, np.inf, (1.0 - known) * unit))
            least = (qq - far * far - 2 * error) / size ** 2
        else:
            own = q / n[:, None] if self.metric == "cosine" else q
            length = np.sqrt(np.einsum("ij,ij->i", own, own))
            length[length == 0] = 1.0
            w = (own / length[:, None]).astype(np.float32) @ self.x32.T
            scale = length * self.size
            if not (scale > 0).all() or not np.isfinite(scale).all():
                return None
            error = self.error * scale
            low = _kth_bound(w, k).astype(float) * scale if some else np.full(len(q), -np.inf)
            least = low - 2 * error - 1.5 * unit
            if known is not None:
                least = np.maximum(least, np.where(known == NO_FLOOR, -np.inf, (known - 1.5) * unit - error))
            least = least / scale
        least = least - 1e-12 * np.where(np.isfinite(least), np.abs(least), 0.0)
        return w >= np.nextafter(least.astype(np.float32), np.float32(-np.inf))[:, None]


def _score_block(Q, qn, qkeys_np, X, xn, ikeys, k, digits, metric, exclude_self, floor=None):
    """Top-k (query row, index row, scaled score) of one index block against all queries.

    One matrix product gives a value ``w`` per pair that orders a query's pairs as the score does (for
    ``l2``: ``2 q x - |x|^2``, which loses digits by cancellation). It only selects: pairs that may
    reach the query's k-th best here (:func:`_kth_bound`), and its k-th best so far (``floor``, scaled
    scores), within the errors of ``w`` and of the rounding. These few are scored and ranked. The
    product is in single precision (:class:`_Single`), and again in double where that leaves many pairs.
    """
    nb = X.shape[0]
    rank = _key_rank(ikeys)
    ik_np = ikeys.to_numpy(zero_copy_only=False) if exclude_self else None
    if not nb or not len(Q):
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, empty
    # rows of the query's own key are no answers, so that many more must reach the bound
    wanted = k + (int(pc.max(pc.value_counts(ikeys).field("counts")).as_py()) if exclude_self else 0)
    unit = 10.0 ** -digits
    single = _Single(X, xn, metric)
    step = max(1, TILE_CELLS // nb)
    out_q, out_x, out_s = [], [], []
    for start in range(0, Q.shape[0], step):
        q, n = Q[start:start + step], qn[start:start + step]
        known = None if floor is None else floor[start:start + step]
        near = single.near(q, n, known, wanted, unit) if single.usable else None
        at = _set_at(near) if near is not None else None
        d = None
        if at is None or len(at) > near.size // SINGLE_SHARE:
            near, d = _near(q, n, X, xn, known, wanted, unit, metric)
            at = np.flatnonzero(near)
        row, col = np.divmod(at, nb)
        if metric == "l2":
            s = -_distances(q, X, row, col)
        else:
            s = d.ravel()[at] if d is not None else _pair_dots(q, X, row, col)
            if metric == "cosine":
                s = s / (n[row] * xn[col])
        si = _scaled_round(s, digits)
        own = qkeys_np[start:start + step][row] == ik_np[col] if exclude_self else None
        if len(at) > near.size // 4:             # many equal scores: a selection beats a sort
            cells, mask = np.zeros(near.shape, dtype=np.int64), ~near
            cells[row, col] = si
            if own is not None:
                mask[row[own], col[own]] = True
            qi, xi = _topk_rows(cells, rank, k, mask)
            si = cells[qi, xi]
        else:
            if own is not None:
                row, col, si = row[~own], col[~own], si[~own]
            order = np.lexsort((rank[col], -si, row))
            row, col, si = row[order], col[order], si[order]
            best = np.arange(len(row)) - np.searchsorted(row, np.arange(len(q)))[row] < k
            qi, xi, si = row[best], col[best], si[best]
        out_q.append(qi + start)
        out_x.append(xi)
        out_s.append(si)
    return np.concatenate(out_q), np.concatenate(out_x), np.concatenate(out_s)


def _near(q, n, X, xn, known, wanted, unit, metric):
    """The pairs of a tile that may be answers, by a product in double, and the product."""
    xx = np.einsum("ij,ij->i", X, X) if metric == "l2" else None
    d = q @ X.T
    w = 2.0 * d - xx if metric == "l2" else d * (1.0 / xn) if metric == "cosine" else d
    low = _kth_bound(w, wanted) if known is None or (known == NO_FLOOR).any() else np.full(len(q), -np.inf)
    if metric == "l2":
        qq = np.einsum("ij,ij->i", q, q)
        error = 8 * (X.shape[1] + 4) * np.finfo(float).eps * (qq + xx.max())
        far = np.sqrt(np.maximum(qq - low, 0.0) + error) + 1.5 * unit
        if known is not None:
            far = np.minimum(far, np.where(known == NO_FLOOR, np.inf, (1.0 - known) * unit))
        least = qq - far * far - 2 * error
    else:
        size = n if metric == "cosine" else np.ones(len(q))
        least = low - 1.5 * unit * size
        if known is not None:
            least = np.maximum(least, np.where(known == NO_FLOOR, -np.inf, (known - 1.5) * unit * size))
        least = least - 1e-12 * np.where(np.isfinite(least), np.abs(least), 0.0)
    return w >= least[:, None], d


class _Best:
    """The k best index rows of every query (a number) over several blocks; ``floor`` holds the scaled
    score of a query's k-th best once it has one."""

    def __init__(self, queries: int, k: int):
        self.k, self.rows, self.held, self.floor = k, [], 0, np.full(queries, NO_FLOOR, dtype=np.int64)

    def add(self, qi: np.ndarray, xi: np.ndarray, si: np.ndarray, index: dict[str, pa.Array]) -> None:
        """``index``: the columns of the block's rows, its key as ``_ik``."""
        if not len(qi):
            return
        found = pa.table({"_q": pa.array(qi), "score": pa.array(si), **{c: v.take(pa.array(xi)) for c, v in index.items()}})
        self.rows.append(found)
        if len(self.rows) == 1 or sum(t.num_rows for t in self.rows[1:]) > max(self.held // 2, self.k * 256):
            self._reduce()

    def _reduce(self) -> None:
        best = _reduce_topk(pa.concat_tables(self.rows), "_q", "_ik", self.k)
        self.rows, self.held = [best], best.num_rows
        q, si = best.column("_q").to_numpy(), best.column("score").to_numpy()
        last = np.flatnonzero(np.append(q[1:] != q[:-1], True))
        count = np.diff(np.append(-1, last))
        full = last[count == self.k]
        self.floor[q[full]] = si[full]

    def table(self) -> pa.Table | None:
        if len(self.rows) > 1:
            self._reduce()
        return self.rows[0] if self.rows else None


def _reduce_topk(tbl: pa.Table, qk: str, ik: str, k: int) -> pa.Table:
    """Keep the k best rows per query of a candidate table (score desc, key asc)."""
    if tbl.num_rows == 0:
        return tbl
    tbl = tbl.sort_by([(qk, "ascending"), ("score", "descending"), (ik, "ascending")])
    keys = tbl.column(qk).to_numpy()
    change = np.empty(len(keys), dtype=bool)
    change[0] = True
    change[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(change)
    group = np.cumsum(change) - 1
    pos = np.arange(len(keys)) - starts[group]
    return tbl.filter(pa.array(pos < k))


def _matrix(col: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Rows of a dense list column, or of a sparse ``struct<indices, values>`` column, as a
    float64 matrix (sparse rows are scattered into zeros here, inside the task)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_struct(col.type):
        idx, val = col.field("indices"), col.field("values")
        out = np.zeros((len(col), dim), dtype=np.float64)
        rows = pc.list_parent_indices(idx).to_numpy(zero_copy_only=False)
        out[rows, pc.list_flatten(idx).to_numpy(zero_copy_only=False)] = (
            pc.list_flatten(val).to_numpy(zero_copy_only=False))
        return out
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _usable_norms(norms) -> np.ndarray:
    n = pc.fill_null(norms, 0.0).to_numpy(zero_copy_only=False)
    return (n > 0) & np.isfinite(n)


def _valid_rows(tbl: pa.Table, vec: str, nrm: str, dim: int, metric: str) -> pa.Table:
    """Rows with a present, ``dim``-wide vector without null, NaN or infinite entries (and a
    finite norm > 0 under cosine); the others take no part in the search."""
    col = tbl.column(vec).combine_chunks()
    if pa.types.is_struct(col.type):  # sparse: same number of indices and values, all in range
        idx, val = col.field("indices"), col.field("values")
        n_idx = pc.fill_null(pc.list_value_length(idx), -1).to_numpy(zero_copy_only=False)
        n_val = pc.fill_null(pc.list_value_length(val), -2).to_numpy(zero_copy_only=False)
        ok = pc.is_valid(col).to_numpy(zero_copy_only=False) & (n_idx == n_val)
        flat = pc.list_flatten(idx)
        if len(flat):
            at = flat.to_numpy(zero_copy_only=False)
            bad = pc.is_null(flat).to_numpy(zero_copy_only=False) | (np.nan_to_num(at, nan=-1) < 0) | (np.nan_to_num(at, nan=-1) >= dim)
            bad |= ~np.isfinite(pc.list_flatten(val).to_numpy(zero_copy_only=False))
            ok[np.unique(pc.list_parent_indices(idx).to_numpy(zero_copy_only=False)[bad])] = False
        if metric == "cosine":
            ok &= _usable_norms(tbl.column(nrm))
        return tbl if ok.all() else tbl.filter(pa.array(ok))
    ok = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False) == dim
    values = pc.list_flatten(col).to_numpy(zero_copy_only=False)                     # a null is NaN here
    bad = ~np.isfinite(values if values.dtype.kind == "f" else values.astype(np.float64))
    if bad.any():
        ok[pc.list_parent_indices(col).to_numpy(zero_copy_only=False)[bad]] = False
    if metric == "cosine":
        ok &= _usable_norms(tbl.column(nrm))
    return tbl if ok.all() else tbl.filter(pa.array(ok))


def _candidates(qtbl_cols: dict, qi, ikeys, payload_cols: dict, xi, si, digits, out_schema) -> pa.Table:
    cols = {name: arr.take(pa.array(qi)) for name, arr in qtbl_cols.items()}
    cols["__ik"] = ikeys.take(pa.array(xi))
    for name, arr in payload_cols.items():
        cols[name] = arr.take(pa.array(xi))
    cols["score"] = pa.array(si.astype(np.float64) / float(10 ** digits), type=pa.float64())
    return pa.table(cols).rename_columns(out_schema.names).cast(out_schema)


# ----------------------------------------------------------------------------- plans

def _output_schema(q: DataFrame, x: DataFrame, query_key: str, query_payload, index_key: str,
                   payload) -> StructType:
    qf = {f.name: f for f in q.schema.fields}
    xf = {f.name: f for f in x.schema.fields}
    fields = [StructField(query_key, qf["_qk"].dataType)]
    fields += [StructField(c, qf[f"_qp{i}"].dataType) for i, c in enumerate(query_payload)]
    fields += [StructField(index_key, xf["_ik"].dataType)]
    fields += [StructField(c, xf[c].dataType) for c in payload]
    fields += [StructField("score", DoubleType())]
    return StructType(fields)


def knn_search(queries: DataFrame, index: DataFrame, *, dim: int, k: int = 10,
               query_key: str = "query_id", query_vec: str = "query_vec",
               index_key: str = "link", index_vec: str = "emotions_embeddings",
               payload: Sequence[str] = (), query_payload: Sequence[str] = (),
               query_norm: str | None = None, index_norm: str | None = None,
               metric: str = "cosine", exclude_self: bool = False, digits: int = 6,
               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, few_vectors: bool = False) -> DataFrame:
    """Top ``k`` index rows per query: ``query_key, query_payload..., rank, index_key,
    payload..., score``. Rows without a valid ``dim``-wide vector (or with norm 0 under
    cosine) take no part. Keys must be unique on each side. ``query_norm`` / ``index_norm``
    name precomputed norm columns (else norms are computed here). Give a stored index if the
    queries exceed ``max_broadcast_bytes``: it is then read in several passes.

    ``few_vectors``: many index rows have equal vectors (embeddings of labels, say). More than a few
    queries then meet the distinct vectors, where these fit the broadcast; the answers are the same."""
    if metric not in ("cosine", "dot", "l2"):
        raise ValueError("metric must be 'cosine', 'dot' or 'l2'")
    if query_key == index_key or set(query_payload) & set(payload):
        raise ValueError("output column names of the two sides must differ")
    # Rows with a missing or wrong-width vector (or norm 0 under cosine) are dropped inside
    # the Arrow tasks, not by a Spark filter: a filter on a computed vector would be pushed
    # below its projection and compute the vector twice.
    q = queries.select(
        F.col(query_key).alias("_qk"), F.col(query_vec).alias("_qv"),
        (F.col(query_norm) if query_norm else norm(query_vec)).cast("double").alias("_qn"),
        *[F.col(c).alias(f"_qp{i}") for i, c in enumerate(query_payload)])
    sparse_index = isinstance(index.schema[index_vec].dataType, StructType)
    index_n = F.col(index_norm) if index_norm else (sparse_norm(index_vec) if sparse_index else norm(index_vec))
    x = index.select(
        F.col(index_key).alias("_ik"), F.col(index_vec).alias("_iv"),
        index_n.cast("double").alias("_in"), *[F.col(c) for c in payload])
    schema = _output_schema(q, x, query_key, query_payload, index_key, payload)
    arrow_schema = to_arrow_schema(schema)

    def answers(local: pa.Table):
        return _broadcast_scores(_valid_rows(local, "_qv", "_qn", dim, metric), x, schema, arrow_schema, dim, k, digits, metric,
                                 exclude_self, query_payload, payload)

    def ranked(partial: DataFrame) -> DataFrame:
        w = Window.partitionBy(query_key).orderBy(F.desc("score"), F.asc(index_key))
        top = partial.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        return top.select(query_key, *query_payload, "rank", index_key, *payload, "score")

    spark = queries.sparkSession
    bounded_batches(spark)
    if few_vectors and not exclude_self and len(q.select("_qk").limit(FEW_QUERIES + 1).collect()) > FEW_QUERIES:
        held = scratch_path(spark, "knn-vectors")
        _distinct_vectors(x, dim, k, metric, payload).write.parquet(held)
        distinct = spark.read.parquet(held)
        # JSON text is longer than the columns that are broadcast
        size = distinct.agg(F.sum(F.octet_length("_vk") + F.octet_length(F.to_json("_rows")))).first()[0] or 0
        if size <= max_broadcast_bytes:
            spread = q.repartition(2 * spark.sparkContext.defaultParallelism)
            return ranked(_score_queries(spread, distinct.toArrow(), schema, arrow_schema, dim, k, digits, metric,
                                         len(query_payload), payload))
    cap_rows = max(1, max_broadcast_bytes // (8 * dim + 64))
    local = q.limit(cap_rows + 1).toArrow()
    row_bytes = max(8 * dim + 64, local.nbytes // max(local.num_rows, 1))
    if local.num_rows <= cap_rows and local.num_rows * row_bytes <= 2 * max_broadcast_bytes:
        return ranked(answers(local)[0])
    # too many queries for one broadcast: blocks of the budget's size, as many a pass as PASS_BYTES hold
    saved = scratch_path(spark, "knn-queries")
    blocks = math.ceil(q.count() * row_bytes / max_broadcast_bytes)
    # a folder per block, so that a pass reads its own queries only
    (q.withColumn("_block", F.pmod(F.xxhash64("_qk"), F.lit(blocks)).cast("int")).repartition("_block")
     .write.partitionBy("_block").parquet(saved))
    stored = spark.read.schema(StructType(q.schema.fields + [StructField("_block", IntegerType())])).parquet(saved)
    out = scratch_path(spark, "knn-answers")
    per_pass = max(1, PASS_BYTES // max_broadcast_bytes)
    for first in range(0, blocks, per_pass):
        partial, shipped = answers(stored.where(F.col("_block").between(first, first + per_pass - 1)).drop("_block").toArrow())
        ranked(partial).write.mode("append").parquet(out)
        shipped.unpersist()
    return spark.read.parquet(out)


def _broadcast_scores(local: pa.Table, x: DataFrame, schema, arrow_schema, dim, k, digits,
                      metric, exclude_self, query_payload, payload):
    """The partial answers of the queries from one scan of the index, and their broadcast."""
    qcols = {"_qk": local.column("_qk").combine_chunks()}
    for i in range(len(query_payload)):
        qcols[f"_qp{i}"] = local.column(f"_qp{i}").combine_chunks()
    shipped = x.sparkSession.sparkContext.broadcast((qcols, _matrix(local.column("_qv"), dim),
                                                     local.column("_qn").to_numpy().astype(np.float64)))
    payload = list(payload)

    def score(batches):
        qcols, Q, qn = shipped.value
        keys = qcols["_qk"].to_numpy(zero_copy_only=False)
        best = _Best(len(Q), k)
        for batch in batches:
            batch = _valid_rows(pa.Table.from_batches([batch]), "_iv", "_in", dim, metric)
            if batch.num_rows == 0 or not len(Q):
                continue
            ikeys = batch.column("_ik").combine_chunks()
            X = _matrix(batch.column("_iv"), dim)
            xn = batch.column("_in").to_numpy(zero_copy_only=False).astype(np.float64)
            qi, xi, si = _score_block(Q, qn, keys, X, xn, ikeys, k, digits, metric, exclude_self, best.floor)
            best.add(qi, xi, si, {"_ik": ikeys, **{c: batch.column(c).combine_chunks() for c in payload}})
        found = best.table()
        if found is not None:
            own = {c: found.column(c).combine_chunks() for c in ("_ik", *payload)}
            for lo in range(0, found.num_rows, OUT_ROWS):
                at = slice(lo, lo + OUT_ROWS)
                rows = np.arange(lo, min(lo + OUT_ROWS, found.num_rows))
                yield from _candidates(qcols, found.column("_q").to_numpy()[at], own["_ik"], {c: own[c] for c in payload}, rows,
                                       found.column("score").to_numpy()[at], digits, arrow_schema).to_batches()

    return x.mapInArrow(score, schema), shipped


# ----------------------------------------------------------------------------- indexes of few vectors

def _packed(m: np.ndarray) -> list[bytes]:
    """Every row as bytes, equal for equal rows only: positions and values of its entries other than
    zero where that is shorter than all values."""
    m = np.ascontiguousarray(m)
    row, col = np.nonzero(m)
    values, col = m[row, col], col.astype(np.int32)
    ends = np.cumsum(np.bincount(row, minlength=len(m)))
    return [(m[i].tobytes() if (hi - lo) * 12 >= m.shape[1] * 8 else col[lo:hi].tobytes() + values[lo:hi].tobytes())
            for i, (lo, hi) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist()))]


def _unpacked(rows: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim))
    for i, raw in enumerate(rows):
        if len(raw) == 8 * dim:
            out[i] = np.frombuffer(raw)
        else:
            n = len(raw) // 12
            out[i, np.frombuffer(raw, np.int32, n)] = np.frombuffer(raw, np.float64, n, 4 * n)
    return out


def _distinct_vectors(x: DataFrame, dim: int, k: int, metric: str, payload: Sequence[str]) -> DataFrame:
    """``_vk, _in, _rows``: the index's distinct vectors, packed, each with its ``k`` rows of smallest
    key in order. Ties go by key, so no other row of a vector can be an answer. Packed vectors and
    keys are shuffled, at most k rows a vector and task."""
    fields = {f.name: f for f in x.schema.fields}
    schema = StructType([StructField("_vk", BinaryType()), fields["_in"], fields["_ik"], *[fields[c] for c in payload]])
    names = schema.names

    def pack(batches):
        for b in batches:
            t = _valid_rows(pa.Table.from_batches([b]), "_iv", "_in", dim, metric)
            for lo in range(0, t.num_rows, PACK_ROWS):
                part = t.slice(lo, PACK_ROWS)
                vk = pa.array(_packed(_matrix(part.column("_iv"), dim)), pa.binary())
                yield from pa.table([vk, *[part.column(c) for c in names[1:]]], names=names).to_batches()

    w = Window.partitionBy("_vk", "_in").orderBy(F.asc_nulls_last("_ik"))
    rows = x.mapInArrow(pack, schema).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    own = F.array_sort(F.collect_list(F.struct("_rn", "_ik", *payload)))        # k rows at most
    return rows.groupBy("_vk", "_in").agg(own.alias("_rows"))


def _score_queries(q: DataFrame, local: pa.Table, schema, arrow_schema, dim, k, digits, metric, n_query_payload,
                   payload) -> DataFrame:
    """The answers of the queries where they lie, from a broadcast of the index's distinct vectors.

    The k best rows of a query are rows of its k best vectors by score and smallest key."""
    lists = local.column("_rows").combine_chunks()
    rows = lists.flatten()
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    members = {c: rows.field(c) for c in ("_ik", *payload)}
    shipped = q.sparkSession.sparkContext.broadcast((
        local.column("_vk").to_pylist(), local.column("_in").to_numpy().astype(np.float64), size, members))
    names = ["_qk"] + [f"_qp{i}" for i in range(n_query_payload)]
    payload = list(payload)

    def score(batches):
        packed, xn, size, members = shipped.value
        start = np.cumsum(size) - size
        rank, least = _key_rank(members["_ik"]), members["_ik"].take(pa.array(start))
        for batch in batches:
            table = _valid_rows(pa.Table.from_batches([batch]), "_qv", "_qn", dim, metric)
            for at in range(0, table.num_rows, PACK_ROWS):
                t = table.slice(at, PACK_ROWS)
                Q, qn = _matrix(t.column("_qv"), dim), t.column("_qn").to_numpy().astype(np.float64)
                number: dict = {}
                like = np.array([number.setdefault(v, len(number)) for v in zip(_packed(Q), qn.tolist())])
                _, first = np.unique(like, return_index=True)       # equal queries are answered once
                found = []
                for lo in range(0, len(packed), PACK_ROWS):
                    X = _unpacked(packed[lo:lo + PACK_ROWS], dim)
                    qi, xi, si = _score_block(Q[first], qn[first], None, X, xn[lo:lo + PACK_ROWS], least.slice(lo, PACK_ROWS), k,
                                              digits, metric, False)
                    found.append((qi, xi + lo, si))
                if not found:
                    continue
                qi, xi, si = (np.concatenate(c) for c in zip(*found))
                n = size[xi]
                row = np.repeat(start[xi] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                qi, si = np.repeat(qi, n), np.repeat(si, n)
                order = np.lexsort((rank[row], -si, qi))
                qi, row, si = qi[order], row[order], si[order]
                head = np.searchsorted(qi, np.arange(len(first) + 1))
                best = np.arange(len(qi)) - head[qi] < k
                qi, row, si = qi[best], row[best], si[best]
                head = np.searchsorted(qi, np.arange(len(first) + 1))
                n = (head[1:] - head[:-1])[like]                    # answers of every query of the slice
                hit = np.repeat(head[:-1][like] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                qcols = {c: t.column(c).combine_chunks() for c in names}
                yield from _candidates(qcols, np.repeat(np.arange(t.num_rows), n), members["_ik"], {c: members[c] for c in payload},
                                       row[hit], si[hit], digits, arrow_schema).to_batches()

    return q.mapInArrow(score, schema)


def knn_single(index: DataFrame, query: Sequence[float], *, k: int = 10, index_key: str = "link",
               index_vec: str = "emotions_embeddings", payload: Sequence[str] = (),
               digits: int = 6) -> DataFrame:
    """Top ``k`` rows of the index for one query vector (L3): JVM expressions only, planned
    as TakeOrderedAndProject (a per-partition top-k, then a merge of k rows per partition).

    Rows whose score is undefined (wrong width, null entries, norm 0) score null, sort last
    and are dropped after the limit, where no filter can be pushed below the scoring.
    """
    from cadenza.functions.vectors import dot, round_half_away

    qv = F.array(*[F.lit(float(v)) for v in query])
    dim = len(query)
    qn = math.sqrt(sum(float(v) * float(v) for v in query))
    if qn == 0:
        raise ValueError("query vector has norm 0")
    n = norm(index_vec)
    score = F.when(has_dim(index_vec, dim) & (n > 0) & finite_norm(n),
                   round_half_away(dot(index_vec, qv) / (F.lit(qn) * n), digits))
    top = (index.select(index_key, *payload, score.alias("score"))
           .orderBy(F.desc_nulls_last("score"), F.asc(index_key)).limit(k)
           .where(F.col("score").isNotNull()))
    w = Window.orderBy(F.desc("score"), F.asc(index_key))   # k rows at most
    return top.select(F.row_number().over(w).alias("rank"), index_key, *payload, "score")
