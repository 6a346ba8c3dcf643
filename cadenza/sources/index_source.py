"""The versioned index as a Spark data source (S9, S11): ``spark.read.format("cadenza_index").load(base)``.

A version is written in buckets of the key: ``crc32(link) % buckets`` names a row's bucket, and a file
holds rows of one bucket. So a scan has one partition per bucket, which merges that bucket of the newest
base with that of the deltas after it (the rule of :func:`cadenza.operators.index.merge`) without a
shuffle, and a filter ``link = ..`` or ``link IN (..)`` is pushed down to the buckets and row groups that
can hold those keys. Batches read one version's state:

* ``version``: the index as of that version (the newest one by default);
* ``changes``: ``true`` gives the rows of every version as they were written, with ``seq``, ``deleted``
  and ``version``. Streams read this form: versions are their offsets, ``startingVersion`` (0) the last
  one not read.

Writes append one version: ``kind`` (``base`` or ``delta``), ``buckets`` (all versions after a base have
its number) and ``source`` (a retry of the same source rewrites its version). Tasks write aside; the
commit moves the files of the tasks that succeeded and writes the metadata last, so a lost task or job
leaves nothing that a reader sees. :func:`cadenza.operators.index.read_index` reads the same versions.

A task holds one bucket's changes and streams its base in batches, so buckets are sized by bytes
(:func:`cadenza.operators.index.bucket_count`). The files are opened by Arrow in the tasks: the base must
be a path or URI that Arrow's file systems know (a shared mount, HDFS, S3, GCS). Spark passes no column
pruning to Python sources; ``columns`` (comma-separated) names the index columns to read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import IntegerType, StructField, StructType

from cadenza.operators.index import BASE, DELTA, MIN_BUCKETS, with_state

NAME, KEY = "cadenza_index", "link"
STATE = ("seq", "deleted")
BATCH_ROWS = 4096


def bucket_of(key: str | None, buckets: int) -> int:
    return 0 if key is None else zlib.crc32(key.encode()) % buckets


def _open(base: str) -> tuple[pafs.FileSystem, str]:
    if base.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + base[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(base) if "://" in base else (pafs.LocalFileSystem(), base)


@dataclass(frozen=True)
class Version:
    number: int
    meta: dict

    def files(self, bucket: int) -> list[str]:
        return [f"v={self.number:08d}/{name}" for name in self.meta["files"].get(str(bucket), [])]


def versions_of(base: str) -> list[Version]:
    """The complete versions, ascending."""
    fs, root = _open(base)
    found = []
    for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
        if info.base_name.startswith("v="):
            meta = f"{info.path}/_meta"
            if fs.get_file_info(meta).type == pafs.FileType.File:
                with fs.open_input_stream(meta) as f:
                    found.append(Version(int(info.base_name[2:]), json.loads(f.read())))
    return sorted(found, key=lambda v: v.number)


def state_versions(base: str, until: int | None) -> list[Version]:
    """The versions that make up the index as of ``until``: a base (if any) and the deltas after it."""
    all_versions = versions_of(base)
    if until is not None and until not in [v.number for v in all_versions]:
        raise ValueError(f"version {until} of {base} is not there")
    upto = [v for v in all_versions if until is None or v.number <= until]
    if not upto:
        raise ValueError(f"no index version under {base}")
    start = max((i for i, v in enumerate(upto) if v.meta["kind"] == BASE), default=0)
    if upto[start].meta["kind"] != BASE and all_versions[0].number > 1:
        raise ValueError(f"the base that this version of {base} needs is gone")
    chosen = upto[start:]
    if len({v.meta.get("buckets") for v in chosen}) != 1 or not chosen[0].meta.get("buckets"):
        raise ValueError("these versions are not in the same buckets: write a base through this source first")
    return chosen


@dataclass
class Bucket(InputPartition):
    """Files of one bucket: (version, is it the base, path) each."""

    files: list[tuple[int, bool, str]]

    def __init__(self, files):
        super().__init__(None)
        self.files = files


def bucket_files(chosen: list[Version], bucket: int) -> Bucket:
    """What makes up a bucket in the versions of :func:`state_versions`."""
    return Bucket([(v.number, v.meta["kind"] == BASE, p) for v in chosen for p in v.files(bucket)])


class _Files:
    """Reads files of the index in the tasks."""

    def __init__(self, base: str, schema: StructType):
        self.base, self.names = base, schema.names
        self.keys: list[str] | None = None      # pushed down: only these keys

    def scan(self, paths: list[str], columns: list[str]) -> Iterator[pa.RecordBatch]:
        if not paths:
            return
        fs, root = _open(self.base)
        wanted = None if self.keys is None else pc.field(KEY).isin(pa.array(self.keys, pa.string()))
        data = pds.dataset([f"{root}/{p}" for p in paths], filesystem=fs, format="parquet")
        for batch in data.to_batches(columns=columns, filter=wanted, batch_size=BATCH_ROWS, batch_readahead=1, use_threads=False,
                                     fragment_readahead=1):
            if batch.num_rows:
                yield batch


def newest(changes: list[tuple[int, pa.RecordBatch]]) -> pa.Table | None:
    """Per key the change of the largest ``seq``, of equal ones that of the latest version."""
    if not changes:
        return None
    table = pa.concat_tables([pa.Table.from_batches([b]).append_column("_version", pa.array(np.full(b.num_rows, v)))
                              for v, b in changes])
    order = pc.sort_indices(table, [(KEY, "ascending"), ("seq", "descending"), ("_version", "descending")])
    keys = pc.take(table[KEY], order).combine_chunks()
    first = np.ones(len(keys), bool)
    if len(keys) > 1:
        same = pc.equal(keys[1:], keys[:-1])
        both_null = pc.and_(pc.is_null(keys[1:]), pc.is_null(keys[:-1]))
        first[1:] = ~pc.coalesce(same, both_null).to_numpy(zero_copy_only=False)
    return pc.take(table, order.filter(pa.array(first))).drop_columns(["_version"]).combine_chunks()


def merged(base: Iterator[pa.RecordBatch], changes: pa.Table | None) -> Iterator[pa.RecordBatch]:
    """A bucket's state: base rows that no change of their ``seq`` or a larger one replaces, then the
    changes that no base row of a larger ``seq`` beats; deleted rows are left out."""
    if changes is None:
        for batch in base:
            yield batch.filter(pc.invert(batch["deleted"]))
        return
    keys = changes[KEY].combine_chunks()
    seq = changes["seq"].to_numpy()
    lost = np.zeros(len(keys), bool)
    for batch in base:
        at = pc.index_in(batch[KEY], value_set=keys, skip_nulls=True)
        met = at.is_valid().to_numpy(zero_copy_only=False)
        place = at.fill_null(0).to_numpy(zero_copy_only=False)
        older = met & (batch["seq"].to_numpy(zero_copy_only=False) > seq[place])
        lost[place[older]] = True
        yield batch.filter(pa.array(~met | older)).filter(pc.invert(batch["deleted"].filter(pa.array(~met | older))))
    keep = pc.and_(pa.array(~lost), pc.invert(changes["deleted"].combine_chunks()))
    yield from changes.filter(keep).to_batches(max_chunksize=BATCH_ROWS)


class IndexReader(DataSourceReader):
    def __init__(self, base: str, schema: StructType, until: int | None):
        self.files, self.until = _Files(base, schema), until

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and tuple(f.attribute) == (KEY,):
                keys = [f.value] if isinstance(f, EqualTo) else list(f.value)
                known = self.files.keys
                self.files.keys = [k for k in keys if k is not None and (known is None or k in known)]
            else:
                yield f

    def partitions(self) -> list[Bucket]:
        chosen = state_versions(self.files.base, self.until)
        n = chosen[0].meta["buckets"]
        keys = self.files.keys
        wanted = range(n) if keys is None else sorted({bucket_of(k, n) for k in keys})
        parts = [bucket_files(chosen, b) for b in wanted]
        return [p for p in parts if p.files] or [Bucket([])]

    def read(self, partition: Bucket) -> Iterator[pa.RecordBatch]:
        columns = list(dict.fromkeys([*self.files.names, KEY, *STATE]))
        changes = newest([(v, b) for v, is_base, p in partition.files if not is_base
                          for b in self.files.scan([p], columns)])
        base = self.files.scan([p for _, is_base, p in partition.files if is_base], columns)
        for batch in merged(base, changes):
            yield batch.select(self.files.names)


def _change_files(base: str, after: int, until: int | None) -> list[Bucket]:
    return [Bucket([(v.number, False, p)]) for v in versions_of(base)
            if v.number > after and (until is None or v.number <= until)
            for b in range(v.meta.get("buckets") or 0) for p in v.files(b)]


def _change_rows(files: _Files, partition: Bucket) -> Iterator[pa.RecordBatch]:
    for version, _, path in partition.files:
        for batch in files.scan([path], [n for n in files.names if n != "version"]):
            yield batch.append_column("version", pa.array(np.full(batch.num_rows, version, np.int32)))


class ChangesReader(IndexReader):
    """The rows of all versions as they were written."""

    def partitions(self) -> list[Bucket]:
        return _change_files(self.files.base, 0, self.until) or [Bucket([])]

    def read(self, partition: Bucket) -> Iterator[pa.RecordBatch]:
        return _change_rows(self.files, partition)


class ChangesStream(DataSourceStreamReader):
    """The same as a stream: a version is read when its metadata is there, and once."""

    def __init__(self, base: str, schema: StructType, after: int):
        self.files, self.after = _Files(base, schema), after

    def initialOffset(self) -> dict:
        return {"version": self.after}

    def latestOffset(self) -> dict:
        return {"version": max([self.after] + [v.number for v in versions_of(self.files.base)])}

    def partitions(self, start: dict, end: dict) -> list[Bucket]:
        return _change_files(self.files.base, start["version"], end["version"])

    def read(self, partition: Bucket) -> Iterator[pa.RecordBatch]:
        return _change_rows(self.files, partition)


@dataclass
class Written(WriterCommitMessage):
    """Files that a task wrote aside: (bucket, name)."""

    files: list[tuple[int, str]]


class IndexWriter(DataSourceArrowWriter):
    def __init__(self, base: str, schema: StructType, kind: str, buckets: int, source: str | None):
        if kind not in (BASE, DELTA):
            raise ValueError("kind must be 'base' or 'delta'")
        there = versions_of(base)
        again = [v.number for v in there if source is not None and v.meta.get("source") == source]
        before = [v for v in there if not again or v.number < again[0]]
        if kind == DELTA and before and before[-1].meta.get("buckets") != buckets:
            raise ValueError("a delta must have the buckets of the version before it")
        self.base, self.buckets = base, buckets
        self.version = again[0] if again else max([v.number for v in there], default=0) + 1
        self.aside = f"v={self.version:08d}/_aside-{uuid.uuid4().hex}"
        self.meta = {"kind": kind, "source": source, "compacts": None, "buckets": buckets, "schema": schema.json()}

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _open(self.base)
        folder, task = f"{root}/{self.aside}", uuid.uuid4().hex
        fs.create_dir(folder, recursive=True)
        files, out, current = [], None, None
        try:
            for batch in iterator:
                ids = np.array([bucket_of(k, self.buckets) for k in batch[KEY].to_pylist()], np.int64)
                order = np.argsort(ids, kind="stable")
                cuts = np.flatnonzero(np.diff(ids[order])) + 1
                for rows in np.split(order, cuts) if len(order) else []:
                    if ids[rows[0]] != current:      # rows come sorted by bucket: one open file at a time
                        if out is not None:
                            out.close()
                        current = int(ids[rows[0]])
                        name = f"b{current:06d}-{task}-{len(files):06d}.parquet"
                        files.append((current, name))
                        out = pq.ParquetWriter(f"{folder}/{name}", batch.schema, filesystem=fs)
                    out.write_batch(batch.take(pa.array(rows)))
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _open(self.base)
        folder = f"{root}/v={self.version:08d}"
        fs.create_dir(folder, recursive=True)
        old = [i.path for i in fs.get_file_info(pafs.FileSelector(folder)) if i.type == pafs.FileType.File]
        if f"{folder}/_meta" in old:                 # a retry: from here on nobody sees the version
            fs.delete_file(f"{folder}/_meta")
        files: dict[str, list[str]] = {}
        for bucket, name in (f for m in messages if m is not None for f in m.files):
            fs.move(f"{root}/{self.aside}/{name}", f"{folder}/{name}")
            files.setdefault(str(bucket), []).append(name)
        for path in old:
            if not path.endswith("/_meta"):
                fs.delete_file(path)
        self.abort(messages)
        with fs.open_output_stream(f"{folder}/_meta") as f:
            f.write(json.dumps(self.meta | {"files": files}).encode())

    def abort(self, messages) -> None:
        fs, root = _open(self.base)
        if fs.get_file_info(f"{root}/{self.aside}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{self.aside}")


class IndexSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def _changes(self) -> bool:
        return str(self.options.get("changes", "false")).lower() == "true"

    def _version(self) -> int | None:
        return int(self.options["version"]) if "version" in self.options else None

    def schema(self) -> StructType:
        stored = [v for v in versions_of(self.options["path"]) if "schema" in v.meta]
        if not stored:
            raise ValueError(f"no index version of this source under {self.options['path']}")
        fields = StructType.fromJson(json.loads(stored[-1].meta["schema"])).fields
        if "columns" in self.options:
            named = [c.strip() for c in self.options["columns"].split(",")]
            fields = [f for c in named for f in fields if f.name == c and c not in STATE] + [f for f in fields if f.name in STATE]
        if self._changes():
            return StructType([*fields, StructField("version", IntegerType())])
        return StructType([f for f in fields if f.name not in STATE])

    def reader(self, schema: StructType) -> DataSourceReader:
        reader = ChangesReader if self._changes() else IndexReader
        return reader(self.options["path"], schema, self._version())

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        if not self._changes():
            raise ValueError("a stream reads changes: set the option changes to true")
        return ChangesStream(self.options["path"], schema, int(self.options.get("startingVersion", 0)))

    def writer(self, schema: StructType, overwrite: bool) -> IndexWriter:
        if overwrite:
            raise ValueError("versions are appended: use mode('append')")
        o = self.options
        return IndexWriter(o["path"], schema, o.get("kind", BASE), int(o.get("buckets", MIN_BUCKETS)), o.get("source"))


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let Spark push filters down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(IndexSource)


def write_index(rows: DataFrame, base: str, kind: str = BASE, buckets: int = MIN_BUCKETS,
                source: str | None = None) -> None:
    """Append a version through the source: rows are dealt by bucket, so a bucket is one file."""
    register(rows.sparkSession)
    bucket = F.coalesce(F.crc32(F.col(KEY).cast("binary")) % buckets, F.lit(0))
    dealt = with_state(rows).repartition(buckets, bucket).sortWithinPartitions(bucket, KEY)
    writer = dealt.write.format(NAME).mode("append").option("kind", kind).option("buckets", buckets)
    (writer if source is None else writer.option("source", source)).save(base)


def open_index(spark: SparkSession, base: str, **options) -> DataFrame:
    """``spark.read.format("cadenza_index")`` with ``options``."""
    register(spark)
    return spark.read.format(NAME).options(**options).load(base)
