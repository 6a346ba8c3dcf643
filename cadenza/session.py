"""Session helpers: a tuned local session for tests and the bench, and the shared folder.

Jobs that cut lineage or write intermediate tables use the folder the cluster names in
``spark.checkpoint.dir``. It is read from the session; a local folder is set only when the
setting is missing *and* the master is local (tests, the bench).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "cadenza",
              driver_memory: str = "16g", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small shuffles feed CPU-heavy stages (embedding, scoring): keep them spread out
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session (created on first use when unset locally)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="cadenza-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Remove what this driver wrote under :func:`scratch_path`, once the results that read it are
    saved elsewhere; returns the number of paths."""
    jvm, conf, n = spark._jvm, spark._jsc.hadoopConfiguration(), len(_SCRATCH)
    while _SCRATCH:
        where = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        where.getFileSystem(conf).delete(where, True)
    return n


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of every query that runs inside go when it ends, not when the driver's garbage
    is next collected. For queries whose results are written: one that runs again shuffles again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def local_frame(spark: SparkSession, rows, schema):
    """A small, bounded DataFrame held in the plan itself (a LocalRelation).

    Built through pandas/Arrow, so using it runs no Python worker and no extra job; the
    rows travel with the plan, so a lost executor never needs to recompute them.
    """
    import pandas as pd
    from pyspark.sql.types import StructType

    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    frame = pd.DataFrame([tuple(r) for r in rows], columns=st.names)
    return spark.createDataFrame(frame, st)


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20,
                 shuffle_share: float = 0.02) -> dict:
    """Settings for a large cluster, from the input size and the total number of cores.

    The plans here shuffle keys, counts and digests, not texts: the largest shuffle is about
    ``shuffle_share`` of the input. Shuffle partitions start at that size over the target
    partition size (AQE merges and splits at run time), never fewer than twice the cores; not
    the input size, since map statuses grow with map tasks × reducers. File splits stay at
    128 MiB so one task's Arrow batches and score blocks fit a few GB of executor memory.
    """
    shuffle = max(2 * cores, -(-int(input_bytes * shuffle_share) // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
