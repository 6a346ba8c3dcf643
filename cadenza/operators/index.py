"""Vector index maintenance.

The index is a table keyed by ``link`` with a vector and its norm. Without a transactional
table format it is a folder of numbered versions, each written once:

* a *base* holds every row (bucketed by the key if asked for),
* a *delta* holds the rows that one refresh changed, and tombstones of the rows it removed.

Every row carries ``seq``, the order of changes to its key, and ``deleted``. :func:`read_index`
merges the newest base with the deltas after it: per key the row of the largest ``seq`` counts, so
a change that arrives late never undoes a newer one, also after a deletion. A refresh of five
songs writes five rows. :func:`compact` writes a new base on demand; :func:`drop_before` removes
versions that nobody reads any more. A version's metadata names the stream and epoch it came
from, so a retried epoch rewrites its own version and a new stream continues the numbering.

* :func:`read_state` reads the index as of any version that is still there, and :func:`read_changes`
  what became of its keys between two versions, with before and after images.
* :func:`snapshot_diff` compares tables that keep no versions: two snapshots, each reduced to one digest
  per key, then a full outer join on the key; the wide columns never enter the shuffle.
* :func:`upsert` applies a diff in batch: the old index minus changed keys, plus the new rows.
* :func:`vector_check` counts what :func:`build_index` keeps out.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.functions.text import is_error_label
from cadenza.functions.vectors import finite_norm, has_dim, norm

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def row_hash(columns: Sequence[str]) -> F.Column:
    """Two hashes (64 and 32 bits, of which 31 each enter the sums) of a row's values, null-aware (a null and a value never hash alike)."""
    parts = []
    for c in columns:
        parts += [F.col(c), F.col(c).isNull()]
    return F.struct(F.xxhash64(*parts).alias("h1"), F.hash(*parts).alias("h2"))


_HALF = 1 << 31


def key_digest(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per key: the number of rows and two sums of bounded row hashes.

    The sums do not depend on row order, so the digest is that of the key's multiset of rows;
    partial aggregation sums map-side, so a key with very many copies never piles up in one
    task, and the join that follows sees each key once.
    """
    h = row_hash(columns)
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.pmod(h["h1"], F.lit(_HALF))).alias("s1"),
        F.sum(F.pmod(h["h2"].cast("bigint"), F.lit(_HALF))).alias("s2"),
    )


def snapshot_diff(old: DataFrame, new: DataFrame, key: str = "link",
                  columns: Sequence[str] | None = None) -> DataFrame:
    """``(key, change)`` for every key inserted, updated or deleted between two snapshots.

    Each side is reduced to one digest per key first (:func:`key_digest`), so only keys and
    digests are shuffled, duplicated keys cannot multiply in the join, and the full outer join
    reuses the aggregations' partitioning. A key whose rows changed in any way is an update.
    """
    cols = list(columns) if columns is not None else [c for c in new.columns if c != key]
    o = key_digest(old, key, cols).select(key, F.struct("n", "s1", "s2").alias("_do"))
    n = key_digest(new, key, cols).select(key, F.struct("n", "s1", "s2").alias("_dn"))
    joined = o.join(n, key, "full_outer")
    change = (F.when(F.col("_do").isNull(), F.lit(INSERT))
              .when(F.col("_dn").isNull(), F.lit(DELETE))
              .when(F.col("_do") != F.col("_dn"), F.lit(UPDATE)))
    return joined.select(key, change.alias("change")).where(F.col("change").isNotNull())


def changed_rows(new: DataFrame, diff: DataFrame, key: str = "link") -> DataFrame:
    """Rows of the new snapshot that were inserted or updated (left semi join)."""
    upserts = diff.where(F.col("change").isin(INSERT, UPDATE)).select(key)
    return new.join(upserts, key, "left_semi")


def upsert(index: DataFrame, diff: DataFrame, fresh: DataFrame, key: str = "link") -> DataFrame:
    """Index after a refresh: drop every changed key, add the fresh rows.

    Inserted keys are dropped too, so applying the same change set twice gives the same index.
    """
    gone = diff.select(key)
    kept = index.join(gone, key, "left_anti")
    return kept.unionByName(fresh.select(*index.columns))


def build_index(vectors: DataFrame, dim: int, key: str = "link", vec: str = "emotions_embeddings",
                drop_errors: bool = True, label: str = "llm_labeled_emotions",
                check_dim: bool = True) -> DataFrame:
    """Rows fit for the index (S9): a ``dim``-wide vector without nulls, a finite norm > 0 and (by
    default) no ERROR label; ``drop_errors=False`` indexes error rows as the reference does.
    Adds ``norm`` when missing. What is kept out, and key uniqueness, is reported by
    :func:`vector_check`. Read the vectors from a written table: Spark pushes these filters below
    the projection that computes a vector, which would then be computed twice.

    ``check_dim=False`` skips the width test for vectors whose width is fixed by their embedder.
    """
    if "norm" not in vectors.columns:
        vectors = vectors.withColumn("norm", norm(vec))
    return vectors.where(fit(dim, vec, label if label in vectors.columns else None, drop_errors, check_dim))


def fit(dim: int, vec: str = "emotions_embeddings", label: str | None = "llm_labeled_emotions",
        drop_errors: bool = True, check_dim: bool = True) -> F.Column:
    """Whether a row with its ``norm`` is fit for the index; never null."""
    ok = (F.col("norm") > 0) & finite_norm(F.col("norm"))
    if check_dim:
        ok = has_dim(vec, dim) & ok
    if drop_errors and label:
        ok = ok & ~F.coalesce(is_error_label(label), F.lit(False))
    return F.coalesce(ok, F.lit(False))


def vector_check(vectors: DataFrame, dim: int, key: str = "link", vec: str = "emotions_embeddings",
                 label: str | None = "llm_labeled_emotions") -> DataFrame:
    """One row of counts: rows, null vectors, wrong width, zero norm, not finite, error labels, and
    rows beyond the first per key (F15). One pass plus a distinct count of the key."""
    v = F.col(vec)
    n = F.col("norm") if "norm" in vectors.columns else norm(vec)
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(v.isNull()).alias("n_null_vector"),
        F.count_if(v.isNotNull() & ~has_dim(vec, dim)).alias("n_wrong_dim"),
        F.count_if(has_dim(vec, dim) & (n == 0)).alias("n_zero_norm"),
        F.count_if(has_dim(vec, dim) & ~finite_norm(n)).alias("n_not_finite"),
    ]
    if label:
        aggs.append(F.count_if(F.coalesce(is_error_label(label), F.lit(False))).alias("n_error_label"))
    aggs.append((F.count(F.lit(1)) - F.count_distinct(F.col(key))).alias("n_duplicate_key"))
    return vectors.agg(*aggs)


def latest_version(df: DataFrame, name: str, version: str) -> DataFrame:
    """Newest version per name, with versions kept as strings compared as numbers (A4):
    ``'10'`` is newer than ``'9'``; versions that are no numbers are counted and left out. One
    partial aggregation per name."""
    number = F.col(version).try_cast("bigint")
    return df.groupBy(name).agg(F.max(number).alias("latest_version"),
                                F.count_if(number.isNull()).alias("n_rejected"))


def latest_per_key(df: DataFrame, key: str, order: Sequence[F.Column]) -> DataFrame:
    """The newest row per key by ``order`` (descending), e.g. before an upsert.

    Planned as a WindowGroupLimit: each task keeps one row per key before the shuffle, so a
    key with very many versions does not pile up in one task.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


# ------------------------------------------------------------------ versioned storage

def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


NAMESPACE = "cadenza"
BASE, DELTA = "base", "delta"
#: Bytes of a bucket, and buckets at least.
BUCKET_BYTES, MIN_BUCKETS = 128 << 20, 8


def version_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/v={version:08d}"


def bucket_count(rows: int, dim: int) -> int:
    """Buckets of a base from its size (``rows`` of ``dim`` floats and some text)."""
    return max(MIN_BUCKETS, -(-rows * (4 * dim + 300) // BUCKET_BYTES))


def _read_meta(spark: SparkSession, path: str) -> dict | None:
    fs, p = _fs(spark, f"{path}/_meta")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _write_meta(spark: SparkSession, path: str, meta: dict) -> None:
    fs, p = _fs(spark, f"{path}/_meta")
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(json.dumps(meta).encode()))
    finally:
        stream.close()


def list_versions(spark: SparkSession, base: str) -> dict[int, dict]:
    """Complete versions under ``base`` (their metadata is written last), ascending."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return {}
    names = sorted(s.getPath().getName() for s in fs.listStatus(p))
    found = {int(n[2:]): _read_meta(spark, f"{base.rstrip('/')}/{n}") for n in names if n.startswith("v=")}
    return {v: m for v, m in found.items() if m is not None}


def _next_version(spark: SparkSession, base: str, source: str | None) -> int:
    """The version that ``source`` (stream and epoch) wrote before, or a new one."""
    versions = list_versions(spark, base)
    if source is not None:
        for v, meta in versions.items():
            if meta.get("source") == source:
                return v
    return max(versions, default=0) + 1


def version_table(base: str, version: int, namespace: str = NAMESPACE) -> str:
    """Catalog name of a bucketed base (derived from its folder)."""
    digest = hashlib.md5(base.rstrip("/").encode()).hexdigest()[:12]
    return f"{namespace}.index_{digest}_v{version:08d}"


def with_state(rows: DataFrame, seq: int = 0) -> DataFrame:
    """Index rows with the columns that versions carry: ``seq`` and ``deleted``."""
    if "seq" not in rows.columns:
        rows = rows.withColumn("seq", F.lit(seq).cast("bigint"))
    return rows if "deleted" in rows.columns else rows.withColumn("deleted", F.lit(False))


def write_version(df: DataFrame, base: str, kind: str = BASE, source: str | None = None,
                  bucket_by: str | None = None, buckets: int = 0, compacts: int | None = None) -> int:
    """Write one version and return its number; a retry of the same ``source`` overwrites its own.
    ``compacts``: the version whose state a base merely rewrites.

    With ``bucket_by`` and ``buckets`` a base is also a bucketed catalog table over the same
    folder: merges and joins on that key shuffle only the other side, never the index. Rows
    are dealt to their buckets first, so a bucket is one file.
    """
    spark = df.sparkSession
    version = _next_version(spark, base, source)
    path = version_path(base, version)
    df = with_state(df)
    if bucket_by and buckets > 0:
        from cadenza.sources.files import ensure_namespace

        ensure_namespace(spark, NAMESPACE)
        (df.repartition(buckets, bucket_by).write.mode("overwrite").bucketBy(buckets, bucket_by).sortBy(bucket_by)
         .option("path", path).saveAsTable(version_table(base, version)))
    else:
        df.write.mode("overwrite").parquet(path)
    _write_meta(spark, path, {"kind": kind, "source": source, "compacts": compacts})
    return version


def _read_version(spark: SparkSession, base: str, version: int) -> DataFrame:
    """A version as its bucketed table when one is registered, else its parquet folder."""
    name = version_table(base, version)
    return spark.table(name) if spark.catalog.tableExists(name) else spark.read.parquet(version_path(base, version))


def merge(rows: DataFrame, changes: DataFrame, key: str = "link") -> DataFrame:
    """Rows (one per key) after ``changes`` (several per key): the largest ``seq`` counts, a change
    before a row of the same ``seq``. Tombstones stay in the result.

    The changes are few: of the rows only key and ``seq`` meet them, once on each side.
    """
    order = [F.desc("seq")] + ([F.desc("_version")] if "_version" in changes.columns else [])
    newest = latest_per_key(changes, key, order).select(rows.columns)
    kept = (rows.join(newest.select(key, F.col("seq").alias("_seq")), key, "left")
            .where(F.col("_seq").isNull() | (F.col("_seq") < F.col("seq"))).select(rows.columns))
    won = (newest.join(rows.select(key, F.col("seq").alias("_seq")), key, "left")
           .where(F.col("_seq").isNull() | (F.col("_seq") <= F.col("seq"))).select(rows.columns))
    return kept.unionByName(won)


def read_state(spark: SparkSession, base: str, version: int | None = None,
               keys: DataFrame | None = None) -> DataFrame | None:
    """All keys of the index with ``seq`` and ``deleted``, or None without a version; as of
    ``version`` if given, and of the ``keys`` (a table of distinct ``link``) only."""
    versions = list_versions(spark, base)
    if version is not None:
        if version not in versions:
            raise ValueError(f"version {version} of {base} is not there")
        first = min(versions)
        versions = {v: m for v, m in versions.items() if v <= version}
        if first > 1 and all(m["kind"] != BASE for m in versions.values()):
            raise ValueError(f"the base that version {version} of {base} needs is gone")
    if not versions:
        return None

    def rows(v: int) -> DataFrame:
        df = _read_version(spark, base, v)
        return df if keys is None else df.join(keys, "link", "left_semi")

    start = max((v for v, m in versions.items() if m["kind"] == BASE), default=0)
    deltas = [rows(v).withColumn("_version", F.lit(v)) for v in versions if v > start]
    changes = None
    for d in deltas:
        changes = d if changes is None else changes.unionByName(d)
    if not start:
        newest = latest_per_key(changes, "link", [F.desc("seq"), F.desc("_version")])
        return newest.drop("_version")
    return rows(start) if changes is None else merge(rows(start), changes)


def _live(state: DataFrame) -> DataFrame:
    return state.where("NOT deleted").drop("seq", "deleted")


def read_index(spark: SparkSession, base: str, version: int | None = None) -> DataFrame | None:
    """The index as of now, or as of ``version``: the newest base until then merged with the deltas
    after it (S11)."""
    state = read_state(spark, base, version)
    return None if state is None else _live(state)


PRE, POST = "update_preimage", "update_postimage"


def read_changes(spark: SparkSession, base: str, after: int, until: int) -> DataFrame:
    """What became of the index from version ``after`` to ``until`` (S8): the index's columns and
    ``change``, ``insert`` and ``delete`` with the row's image, an update as two rows with the images
    before and after it.

    The changes are net: a key that ends as it began, or whose late changes lost, has none. Only
    keys of the deltas in between are read from the versions and compared; rewriting the same state
    (:func:`compact`) is no change. After a base that is not such a rewrite all keys are compared.
    """
    versions = list_versions(spark, base)
    if after > until or not {after, until} <= versions.keys():
        raise ValueError("both versions must be there, and the first must not come after the last")
    between = {v: m for v, m in versions.items() if after < v <= until}
    keys = None
    if all(m["kind"] == DELTA or m.get("compacts") is not None for m in between.values()):
        keys = _read_version(spark, base, after).select("link").limit(0)
        for v, m in between.items():
            if m["kind"] == DELTA:
                keys = keys.union(_read_version(spark, base, v).select("link"))
        keys = keys.distinct()
    old, new = (_live(read_state(spark, base, v, keys)) for v in (after, until))
    rest = [c for c in old.columns if c != "link"]
    both = (old.select("link", F.struct(*rest).alias("_old"))
            .join(new.select("link", F.struct(*rest).alias("_new")), "link", "full_outer")
            .where(~F.col("_old").eqNullSafe(F.col("_new"))))
    o, n = F.col("_old"), F.col("_new")

    def image(change: str, row: F.Column) -> F.Column:
        return F.struct(F.lit(change).alias("change"), row.alias("row"))

    images = (F.when(o.isNull(), F.array(image(INSERT, n))).when(n.isNull(), F.array(image(DELETE, o)))
              .otherwise(F.array(image(PRE, o), image(POST, n))))
    return both.select("link", F.explode(images).alias("_i")).select("link", "_i.change", "_i.row.*")


def compact(spark: SparkSession, base: str, bucket_by: str | None = None, buckets: int = 0) -> int:
    """Write the merged state as a new base; tombstones stay, so late changes still lose."""
    newest = max(list_versions(spark, base), default=0)
    return write_version(read_state(spark, base), base, BASE, None, bucket_by, buckets, compacts=newest)


def drop_before(spark: SparkSession, base: str) -> list[int]:
    """Remove the versions before the newest base, which no read needs; returns their numbers."""
    versions = list_versions(spark, base)
    start = max((v for v, m in versions.items() if m["kind"] == BASE), default=0)
    old = [v for v in versions if v < start]
    for v in old:
        spark.sql(f"DROP TABLE IF EXISTS {version_table(base, v)}")
        fs, p = _fs(spark, version_path(base, v))
        fs.delete(p, True)
    return old
