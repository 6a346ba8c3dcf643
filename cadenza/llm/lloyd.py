"""Centroid clustering (operator 11): Lloyd's rounds over shards of vector dimensions.

Vectors become integers and are cut into column blocks. A *shard* holds one column block of one
block of vectors. In every round the tasks of a column block know only their slice of the
centroids: they compute exact partial squared distances, the blocks of the same vectors are
added by key, and the least total wins (ties: the smaller number). Then every column block sums
its own columns by cluster and replaces its own slice of the centroids. The driver sees the
centroids (``k`` x dimensions, both parameters) and nothing that grows with the vectors.

Assignments are written once per round, so that a lost executor costs one round at most.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import Tables, bounded_batches, written
from cadenza.session import local_frame

#: Vectors in a block: a shard has so many rows at most, an added block so many rows of distances.
VECTOR_BLOCK = 4096
#: Integer components lie within this bound, so that squared distances of 2^7 dimensions fit in a long.
MOST = 1 << 27


def whole_vectors(vectors: DataFrame, dims: int, scale: int, column: str = "embedding") -> DataFrame:
    """``(vec_id, x)`` of the vectors with exactly ``dims`` finite components; x = floor(scale * component).

    Dropped: null vectors, other lengths, null or non-finite components, and components beyond
    ``MOST / scale``, whose squared distances no long could hold.
    """
    v = F.col("v")
    fine = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) <= F.lit(MOST / scale)), F.lit(False))
    return (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
            .where(F.coalesce((F.size(v) == dims) & F.forall(v, fine), F.lit(False)))
            .select("vec_id", F.transform(v, lambda c: F.floor(c * F.lit(float(scale))).cast("int")).alias("x")))


def first_centroids(kept: DataFrame, k: int, tag: str) -> list[list[int]]:
    """The ``k`` vectors of the smallest sha256 of ``tag:vec_id``; ties by components, null ids last."""
    key = F.sha2(F.concat(F.lit(f"{tag}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select("x", key.alias("key")).orderBy(F.col("key").asc_nulls_last(), "x").limit(k).collect()
    return [r["x"] for r in rows]


def _shards(batches, blocks: int, rows: int):
    """Every ``rows`` rows: their ids, then one row per column block with its columns."""
    import pyarrow as pa
    from pyspark import TaskContext

    task, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        dims = len(batch.column("x")[0]) if batch.num_rows else 0
        for lo in range(0, batch.num_rows, rows):
            part = batch.slice(lo, rows)
            x = part.column("x").flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(-1, dims)
            vb, ids = (task << 32) + n, part.column("vec_id")
            n += 1
            cols = [np.ascontiguousarray(c).tobytes() for c in np.array_split(x, blocks, axis=1)]
            listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([vb] * (blocks + 1), pa.int64()), pa.array([-1, *range(blocks)], pa.int32()),
                 pa.concat_arrays([listed, pa.nulls(blocks, listed.type)]), pa.array([None, *cols], pa.binary())],
                names=["vb", "db", "ids", "part"])


def _partial(batches, slices: list[np.ndarray]):
    """Exact partial squared distances of a shard's rows to its slice of every centroid."""
    import pyarrow as pa

    for batch in batches:
        for vb, db, part in zip(*(batch.column(c).to_pylist() for c in ("vb", "db", "part"))):
            own = slices[db]
            x = np.frombuffer(part, "<i4").astype(np.int64).reshape(-1, own.shape[1])
            far = np.empty((len(x), len(own)), "<i8")
            for j, c in enumerate(own):
                far[:, j] = np.square(x - c).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([vb], pa.int64()), pa.array([far.tobytes()], pa.binary())],
                                             names=["vb", "far"])


def _nearest(k: int):
    def add(table):
        """The column blocks of one vector block: partial distances added, the smallest number of the least."""
        import pyarrow as pa

        far = np.zeros((0, k), np.int64)
        for i, raw in enumerate(table.column("far").to_pylist()):
            part = np.frombuffer(raw, "<i8").reshape(-1, k)
            far = part.copy() if i == 0 else far + part
        best = far.argmin(axis=1)
        return pa.table({"vb": table.column("vb").slice(0, 1), "cluster": pa.array([best.astype("<i4").tobytes()], pa.binary()),
                         "distance": pa.array([far[np.arange(len(far)), best].astype("<i8").tobytes()], pa.binary())})
    return add


def _slice_sums(batches, k: int, widths: list[int]):
    """Per task and column block: sums of its columns and counts by cluster."""
    import pyarrow as pa

    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for db, part, cluster in zip(*(batch.column(c).to_pylist() for c in ("db", "part", "cluster"))):
            x = np.frombuffer(part, "<i4").astype(np.int64).reshape(-1, widths[db])
            own = sums.setdefault(db, np.zeros((k, widths[db] + 1), np.int64))
            best = np.frombuffer(cluster, "<i4")
            np.add.at(own, (best, -1), 1)
            np.add.at(own[:, :-1], best, x)
    rows = [(db, j, own[j, -1], own[j, :-1].tolist()) for db, own in sums.items() for j in np.flatnonzero(own[:, -1]).tolist()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
         pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.list_(pa.int64()))],
        names=["db", "cluster", "n", "sums"])


def _assigned(shards: DataFrame, centroids: np.ndarray, blocks: int, tables: Tables) -> DataFrame:
    slices = np.array_split(centroids, blocks, axis=1)
    partial = (shards.where("db >= 0").select("vb", "db", "part")
               .mapInArrow(lambda it: _partial(it, slices), "vb bigint, far binary"))
    return written(partial.groupBy("vb").applyInArrow(_nearest(len(centroids)), "vb bigint, cluster binary, distance binary"),
                   "lloyd-assigned", tables)


def _updated(shards: DataFrame, assigned: DataFrame, centroids: np.ndarray, blocks: int) -> np.ndarray:
    """New centroids: every column block's exact floor(sum / count); a cluster without vectors stays."""
    k, widths = len(centroids), [s.shape[1] for s in np.array_split(centroids, blocks, axis=1)]
    joined = shards.where("db >= 0").select("vb", "db", "part").join(assigned.select("vb", "cluster"), "vb")
    sums = joined.select("db", "part", "cluster").mapInArrow(
        lambda it: _slice_sums(it, k, widths), "db int, cluster int, n bigint, sums array<bigint>")
    total = F.sum(F.col("s").cast("decimal(38,0)"))
    rows = (sums.select("db", "cluster", "n", F.posexplode("sums").alias("at", "s"))
            .groupBy("db", "cluster", "at").agg(total.alias("s"), F.sum("n").cast("decimal(38,0)").alias("n"))
            .select("db", "cluster", "at", F.expr("(s - pmod(s, n)) div n").alias("mean")).collect())
    first = np.concatenate(([0], np.cumsum(widths)))
    new = centroids.copy()
    for r in rows:
        new[r["cluster"], first[r["db"]] + r["at"]] = r["mean"]
    return new


def lloyd(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, blocks: int = 4,
          tag: str = "2", column: str = "embedding") -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` for every kept vector.

    The first centroids are the ``k`` kept vectors of the smallest sha256 of ``tag:vec_id``;
    fewer vectors give fewer centroids. ``rounds`` times every vector is assigned and the
    centroids replaced, then vectors are assigned once more. Repeated rows and repeated ids are
    vectors of their own; a null id stays null. Null and odd vectors are left out
    (:func:`whole_vectors`). An empty table gives an empty result; other columns are not read.
    """
    spark, tables = vectors.sparkSession, Tables()
    blocks = max(1, min(blocks, dims))
    bounded_batches(spark)
    kept, block = whole_vectors(vectors, dims, scale, column), VECTOR_BLOCK
    out = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    shards = written(kept.mapInArrow(lambda it: _shards(it, blocks, block),
                                     "vb bigint, db int, ids array<bigint>, part binary"), "lloyd-shards")
    first = first_centroids(kept, k, tag)
    if not first:
        return local_frame(spark, [], out)
    centroids = np.array(first, np.int64)
    for _ in range(rounds):
        assigned = _assigned(shards, centroids, blocks, tables)
        centroids = _updated(shards, assigned, centroids, blocks)
        tables.drop(spark)
    assigned = _assigned(shards, centroids, blocks, Tables())

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            for ids, cluster, distance in zip(batch.column("ids"), batch.column("cluster").to_pylist(), batch.column("distance").to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(np.frombuffer(cluster, "<i4")), pa.array(np.frombuffer(distance, "<i8"))],
                    names=["vec_id", "cluster", "distance"])

    each = (shards.where("db = -1").select("vb", "ids").join(assigned, "vb").select("ids", "cluster", "distance")
            .mapInArrow(rows, "vec_id bigint, cluster int, distance bigint"))
    inertia = each.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    own, whole = {r["cluster"]: int(r["s"]) for r in inertia}, sum(int(r["s"]) for r in inertia)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = local_frame(spark, [(j, own[j], whole, names[j]) for j in sorted(own)],
                        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return each.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
