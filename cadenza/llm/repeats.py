"""Suffix-array dedup (operator 13): external induced sorting of the text that can repeat.

Every byte covered by a ``length``-byte string that also starts anywhere else goes. Equal strings
must meet in one shard, so the text is routed by its content: the key of a window of ``length``
bytes is the least hash of its ``GRAM``-byte grams, which depends on the window alone. Neighbouring
windows of one key form a *region*. The steps, each over Spark shuffles:

1. Equal texts become one row with a count, bucketed by a 128-bit digest, so that later joins
   on the digest move no text.
2. The places of least grams are counted by key. A key with one place in all documents
   cannot hold a repeat; the regions of the others are listed by text.
3. Regions go to shards by key, equal regions once with their count. A shard's suffixes are
   sorted by external induced sorting (:mod:`cadenza.llm.suffixes`); a window repeats if its
   suffix shares ``length`` bytes or more with a neighbour in sorted order, or if its region
   was counted twice. A key all of whose regions are equal needs no sorting.
4. What repeats is joined back to the regions' places and cut out of the texts.

A shard's queues live on disk, so a hot key costs time in its shard and no memory; regions of
copies are counted before they are sent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import suffixes
from cadenza.llm.common import Tables, bounded_batches, mix64, n_blocks, written
from cadenza.session import scratch_path

#: Bytes of a gram; bytes of text that are hashed at a time; windows of a region at most.
GRAM, SEGMENT, REGION = 48, 256 << 10, 1024
#: Bytes of regions in a shard, about; texts in a bucket, about; regions that a task holds back at most.
SHARD_BYTES, BUCKET_BYTES, HELD = 24 << 20, 24 << 20, 100_000
#: Never part of a text in UTF-8: stands between the regions of a shard.
APART = 0xFF

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _grams(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash (never 0) of the ``gram`` bytes from each place on."""
    n = len(data)
    power = np.cumprod(np.full(n, _BASE, np.uint64))
    back = np.cumprod(np.full(n, _INVERSE, np.uint64))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power, out=total[1:])
    return np.maximum(mix64((total[gram:] - total[:-gram]) * back[:n - gram + 1]), np.uint64(1))


def _sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """The least (or largest) of every ``width`` neighbouring values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = least(out[:-step], out[step:])
        have += step
    return out


def _keyed(data: np.ndarray, cuts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The key of the window from each place on (0: it would cross a cut or the end), and the grams."""
    g = _grams(data, gram)
    keys = _sliding(g, length - gram + 1, np.minimum)
    ends = cuts[np.searchsorted(cuts, np.arange(len(keys)), "right")]
    keys[np.arange(len(keys)) + length > ends] = 0
    return keys, g


def _segments(raw: np.ndarray, off: np.ndarray, length: int, segment: int) -> Iterator[tuple]:
    """``(data, cuts, rows, begins)``: texts side by side, about ``segment`` bytes at a time; a long
    text in parts that overlap by one window. ``begins``: each part's place in its text."""
    parts: list[tuple[int, int, int]] = []
    size = 0

    def out():
        data = np.concatenate([raw[off[r] + lo:off[r] + hi] for r, lo, hi in parts])
        return data, np.cumsum([hi - lo for _, lo, hi in parts]), np.array([r for r, _, _ in parts]), np.array([lo for _, lo, _ in parts])

    for r, n in enumerate(np.diff(off).tolist()):
        for lo in range(0, n - length + 1, segment):
            hi = min(lo + segment + length - 1, n)
            if parts and size + hi - lo > segment + length:
                yield out()
                parts, size = [], 0
            parts.append((r, lo, hi))
            size += hi - lo
    if parts:
        yield out()


def _texts(batch):
    from cadenza.llm.common import text_bytes

    return text_bytes(batch.column("text"))


def _places(batches, length: int, gram: int, segment: int):
    """``(key, n)``: the places of least grams, each as often as its text occurs."""
    import pyarrow as pa

    for batch in batches:
        times = batch.column("times").to_numpy()
        for data, cuts, rows, _ in _segments(*_texts(batch), length, segment):
            keys, g = _keyed(data, cuts, length, gram)
            width = length - gram + 1
            padded = np.concatenate((np.zeros(width - 1, np.uint64), keys, np.zeros(len(g) - len(keys), np.uint64)))
            at = np.flatnonzero(_sliding(padded, width, np.maximum)[:len(g)] == g)
            own = times[rows[np.searchsorted(cuts, at, "right")]]
            yield pa.RecordBatch.from_arrays([pa.array(g[at].view(np.int64)), pa.array(own)], names=["h", "n"])


def _regions(batches, length: int, gram: int, segment: int, region: int):
    """``(h, key, at, n)``: runs of windows of one key in a text."""
    import pyarrow as pa

    for batch in batches:
        names = batch.column("key")
        for data, cuts, rows, begins in _segments(*_texts(batch), length, segment):
            keys, _ = _keyed(data, cuts, length, gram)
            change = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            lo = np.concatenate(([0], change))
            hi = np.concatenate((change, [len(keys)]))
            some = keys[lo] != 0
            lo, hi = lo[some], hi[some]
            parts = -(-(hi - lo) // region)                  # a run of many windows in several regions
            nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
            lo = np.repeat(lo, parts) + nth * region
            n = np.minimum(np.repeat(hi, parts) - lo, region)
            part = np.searchsorted(cuts, lo, "right")
            start = np.concatenate(([0], cuts[:-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[lo].view(np.int64)), names.take(pa.array(rows[part])),
                 pa.array(lo - start[part] + begins[part]), pa.array(n.astype(np.int32))], names=["h", "key", "at", "n"])


def _cut_out(batch, length: int) -> Iterator[tuple]:
    """``(row, shard, key, at, bytes)`` of every listed region of a batch of texts."""
    raw, off = _texts(batch)
    listed = batch.column("regions")
    counts = np.diff(listed.offsets.to_numpy())
    flat = listed.flatten()
    at, n, shard, h = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("at", "n", "shard", "h"))
    row = np.repeat(np.arange(len(counts)), counts)
    lo = off[row] + at
    for r, s, key, a, k, x in zip(row.tolist(), shard.tolist(), h.tolist(), at.tolist(), n.tolist(), lo.tolist()):
        yield r, s, key, a, raw[x:x + k + length - 1].tobytes()


SENT = ["shard", "h", "digest", "part", "times"]


def _sent(batches, length: int, held: int):
    """``(shard, h, digest, part, times)``: a task's regions, equal ones once where they are held."""
    import pyarrow as pa

    seen: dict[bytes, list] = {}

    def out():
        rows = list(seen.items())
        seen.clear()
        for lo in range(0, len(rows), 4000):
            some = rows[lo:lo + 4000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v[0] for _, v in some], pa.int64()), pa.array([v[1] for _, v in some], pa.int64()),
                 pa.array([k for k, _ in some], pa.binary()), pa.array([v[2] for _, v in some], pa.binary()),
                 pa.array([v[3] for _, v in some], pa.int64())], names=SENT)

    for batch in batches:
        times = batch.column("times").to_pylist()
        for r, shard, h, _, part in _cut_out(batch, length):
            digest = hashlib.md5(part).digest()
            own = seen.get(digest)
            if own is None:
                seen[digest] = [shard, h, part, times[r]]
                if len(seen) >= held:
                    yield from out()
            else:
                own[3] += times[r]
    yield from out()


class Shard:
    """The regions of one shard in one text, which grows on disk, and what of it repeats."""

    def __init__(self, length: int):
        self.length, self.room, self.used = length, suffixes.stored(1 << 20, np.uint8), 0
        self.digests, self.starts, self.whole = [], [], []

    def add(self, digest: bytes, part: bytes, times: int) -> None:
        if self.used + len(part) + 1 > len(self.room):
            room = suffixes.stored(2 * (len(self.room) + len(part)), np.uint8)
            room[:self.used] = self.room[:self.used]
            self.room = room
        self.room[self.used:self.used + len(part)] = np.frombuffer(part, np.uint8)
        self.room[self.used + len(part)] = APART
        self.digests.append(digest)
        self.starts.append(self.used)
        self.whole.append(times > 1)
        self.used += len(part) + 1

    def repeats(self) -> Iterator[tuple[bytes, list[int], list[int]]]:
        """``(digest, begins, ends)``: the windows of a region that occur twice or more, as runs."""
        size = self.length
        starts = np.array(self.starts + [self.used])
        text = self.room[:self.used]
        order, shared = suffixes.suffixes(text, size)
        hit = suffixes.stored(self.used + 1, np.bool_)
        for lo in range(0, self.used, suffixes.BLOCK):
            hi = min(lo + suffixes.BLOCK, self.used)
            both = np.append(np.asarray(shared[lo:hi]), shared[hi] if hi < self.used else 0) >= size
            hit[order[lo:hi][both[:-1] | both[1:]]] = True
        for i, (digest, whole) in enumerate(zip(self.digests, self.whole)):
            n = int(starts[i + 1] - starts[i]) - size            # its windows
            own = np.ones(n, bool) if whole else np.asarray(hit[starts[i]:starts[i] + n])
            if own.any():
                edge = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
                yield digest, edge[::2].tolist(), edge[1::2].tolist()


def _sorted_shards(batches, length: int):
    """Rows sorted by shard, key and digest: equal regions of several tasks meet and become one.

    Windows of different keys differ. So where all regions of a key are equal and counted twice
    or more, they repeat whole, and there is nothing to sort; all others go into the shard's text.
    """
    import pyarrow as pa

    shard, now, key, last, alone, equal = None, None, None, None, True, []

    def rows(found):
        for lo in range(0, len(found), 4000):
            some = list(zip(*found[lo:lo + 4000]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some[0], pa.binary()), pa.array(some[1], pa.list_(pa.int32())), pa.array(some[2], pa.list_(pa.int32()))],
                names=["digest", "begins", "ends"])

    def key_done():
        if alone and last[2] > 1:
            equal.append((last[0], [0], [len(last[1]) - length + 1]))
        else:
            shard.add(*last)

    for batch in batches:
        for number, h, digest, part, times in zip(*(batch.column(c).to_pylist() for c in SENT)):
            if last is not None and key == h and now == number:
                if last[0] == digest:
                    last[2] += times
                    continue
                shard.add(*last)
                alone = False
            else:
                if last is not None:
                    key_done()
                if now != number:
                    if shard is not None:
                        yield from rows(list(shard.repeats()))
                    shard, now = Shard(length), number
                key, alone = h, True
                if len(equal) >= 4000:
                    yield from rows(equal)
                    equal.clear()
            last = [digest, part, times]
    if last is not None:
        key_done()
        yield from rows(equal)
        yield from rows(list(shard.repeats()))


def _found_again(batches, length: int):
    """``(digest, key, at)``: where every listed region stands."""
    import pyarrow as pa

    for batch in batches:
        keys = batch.column("key")
        rows = [(hashlib.md5(part).digest(), r, at) for r, _, _, at, part in _cut_out(batch, length)]
        for lo in range(0, len(rows), 50_000):
            some = list(zip(*rows[lo:lo + 50_000]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some[0], pa.binary()), keys.take(pa.array(some[1], pa.int64())), pa.array(some[2], pa.int64())],
                names=["digest", "key", "at"])


def _spans(begins: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the bytes that the windows ``begins..ends`` cover."""
    order = np.argsort(begins, kind="stable")
    lo, hi = begins[order], np.maximum.accumulate(ends[order] + length - 1)
    new = np.append(True, lo[1:] > hi[:-1])
    return lo[new], hi[np.append(np.flatnonzero(new)[1:] - 1, len(hi) - 1)]


def _kept(batches, length: int):
    """``(key, n_removed, n_spans, kept_sha256)`` of the texts with something to remove."""
    import pyarrow as pa

    for batch in batches:
        raw, off = _texts(batch)
        out = []
        for i, (times, hits) in enumerate(zip(batch.column("times").to_pylist(), batch.column("hits"))):
            text = raw[off[i]:off[i + 1]]
            if times > 1:
                lo, hi = np.array([0]), np.array([len(text)])
            else:
                flat = hits.values
                lo, hi = _spans(flat.field("begin").to_numpy(), flat.field("end").to_numpy(), length)
            sha, at = hashlib.sha256(), 0
            for a, b in zip(lo.tolist(), hi.tolist()):
                sha.update(text[at:a])
                at = b
            sha.update(text[at:])
            out.append((int((hi - lo).sum()), len(lo), sha.hexdigest()))
        cols = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())],
            names=["key", "n_removed", "n_spans", "kept_sha256"])


def _bucketed(texts: DataFrame, size: int, tables: Tables) -> tuple[DataFrame, str]:
    """``texts`` as a table bucketed by ``key``: joins on the key leave it where it is."""
    spark = texts.sparkSession
    n = max(n_blocks(size, BUCKET_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = scratch_path(spark, "llm-repeats-texts")
    name = path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
    (texts.repartition(n, "key").write.option("path", path).option("compression", "zstd")
     .bucketBy(n, "key").saveAsTable(name))
    tables.paths[path] = "repeats-texts"
    return spark.table(name), name


def repeated_spans(docs: DataFrame, length: int = 200) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every document.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in
    another document or the same one; strings lie within one document and are those of the
    input. ``kept_sha256``: of the remaining bytes, in order. A null text is empty; a null
    doc_id stays null. Rows are told apart by nothing but their text: equal texts (repeated rows
    too) repeat each other whole if they have ``length`` bytes. An empty table gives an empty
    result. A long text is hashed in parts that overlap by one window. ``length`` must exceed
    the gram's 48 bytes, else grams of half the length are used.
    """
    spark, tables = docs.sparkSession, Tables()
    bounded_batches(spark)
    gram = min(GRAM, max(1, length // 2))
    segment, region, held = SEGMENT, REGION, HELD
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    sha = F.sha2(F.col("text").cast("binary"), 256)
    size = F.octet_length("text").cast("bigint")
    rows = named.select("doc_id", size.alias("n_bytes"), sha.alias("sha"))
    key = F.unhex(F.substring("sha", 1, 32))
    long = (named.select(size.alias("n_bytes"), sha.alias("sha"), "text").where(F.col("n_bytes") >= length)
            .select(key.alias("key"), "text"))
    total = named.agg(F.sum(size)).first()[0] or 0
    texts, name = _bucketed(long.groupBy("key").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("times")), total, tables)
    # keys with two places or more, and the regions that have them
    places = texts.select("text", "times").mapInArrow(lambda it: _places(it, length, gram, segment), "h bigint, n bigint")
    often = places.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    regions = texts.select("key", "text").mapInArrow(lambda it: _regions(it, length, gram, segment, region),
                                                     "h bigint, key binary, at bigint, n int")
    found = written(regions.join(often, "h", "left_semi"), "repeats-regions", tables)
    shards = n_blocks(found.agg(F.sum(F.col("n") + F.lit(length))).first()[0] or 0, SHARD_BYTES)
    place = F.struct("at", "n", "h", F.pmod(F.xxhash64("h"), F.lit(shards)).alias("shard"))
    listed = written(found.groupBy("key").agg(F.collect_list(place).alias("regions")), "repeats-listed", tables)
    both = texts.join(listed.hint("shuffle_hash"), "key")
    sent = both.select("text", "times", "regions").mapInArrow(
        lambda it: _sent(it, length, held), "shard bigint, h bigint, digest binary, part binary, times bigint")
    hits = written(sent.repartition(shards, "shard").sortWithinPartitions("shard", "h", "digest").mapInArrow(
        lambda it: _sorted_shards(it, length), "digest binary, begins array<int>, ends array<int>"), "repeats-hits", tables)
    again = both.select("key", "text", "regions").mapInArrow(lambda it: _found_again(it, length), "digest binary, key binary, at bigint")
    run = F.explode(F.arrays_zip("begins", "ends"))
    spans = (again.join(hits, "digest").select("key", "at", run.alias("run"))
             .groupBy("key").agg(F.collect_list(F.struct((F.col("at") + F.col("run.begins")).alias("begin"),
                                                         (F.col("at") + F.col("run.ends")).alias("end"))).alias("hits")))
    # copies have regions of two places or more, so every text that loses something is listed
    kept = written(texts.join(spans.hint("shuffle_hash"), "key").select("key", "text", "times", "hits").mapInArrow(
        lambda it: _kept(it, length), "key binary, n_removed bigint, n_spans bigint, kept_sha256 string"), "repeats-kept")
    spark.sql(f"DROP TABLE {name}")
    tables.drop(spark)
    return (rows.withColumn("key", key).join(kept, "key", "left")
            .select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
                    F.coalesce("n_spans", F.lit(0).cast("bigint")).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256")))
