"""Phrase collocation mining (operator 12): multikey three-way quicksort of suffix pointers.

Texts are cut into pieces at punctuation and line ends, and pieces into words. A *suffix
pointer* is a word's place, read as the words from there to the end of its piece, ``max_words``
at most. Three passes over Spark shuffles:

1. Word counts by language; with them, the leading pairs of words that hold more than one in
   ``HOT_PARTS`` of all places (at most ``HOT_PARTS`` pairs, so their broadcast is bounded).
2. Pointers are counted within a stretch of text, dealt to buckets by a hash of language and leading
   two words, and sent as one value per bucket: a line per pointer, and the counts. Pointers of a hot pair are dealt by three words, and the pair itself is counted on the way.
3. Each bucket sorts its pointers by three-way partitions, word by word to the maximum depth. The
   size of an equal partition is its phrase's count; partitions below the least count are
   abandoned unsorted.

Scores are exact integers; what is joined afterwards are phrases of the least count or more.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import Tables, bounded_batches, mix64, n_blocks, written
from cadenza.session import local_frame

#: Places that a bucket holds, and buckets that a task sorts one after another, about; bytes of text that are cut into words at a time, about.
BUCKET_POINTERS, BUCKETS_PER_TASK, SLICE_BYTES = 400_000, 4, 4 << 20
#: A leading pair is hot if it holds more than one in so many places. Pairs below that share of a
#: batch are not counted for it, so a pair of twice the share is always found.
HOT_PARTS = 20_000

_END = np.zeros(256, dtype=bool)
_END[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_APART = _END.copy()
_APART[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _slices(raw: np.ndarray, ahead: int, cut: int) -> Iterator[tuple[np.ndarray, int]]:
    """A long text in parts that each end between words, with the bytes of the next ``ahead``
    words behind; pointers start before the given end only."""
    lo, n = 0, len(raw)
    while lo < n:
        hi = min(lo + cut, n)
        while hi < n and not _APART[raw[hi]]:            # to the end of the word
            step = _APART[raw[hi:hi + 4096]]
            hi = hi + int(step.argmax()) if step.any() else min(hi + 4096, n)
        end, room = hi, 4096
        while end < n:                                    # the words that follow
            end = min(hi + room, n)
            apart = _APART[raw[hi:end]]
            if end == n or np.count_nonzero(apart[1:] & ~apart[:-1]) >= ahead:
                break
            room *= 2
        yield raw[lo:end], hi - lo
        lo = hi


class Places:
    """The words of one stretch of bytes: ``ids`` into ``words`` (distinct, exact), and ``next``:
    whether the following word is in the same piece. Only places before ``upto`` start pointers."""

    def __init__(self, raw: np.ndarray, cuts: np.ndarray, upto: int):
        import pyarrow as pa

        data = _LOWER[raw]
        inside = ~_APART[data]
        before = np.zeros_like(inside)
        before[1:] = inside[:-1]
        before[cuts] = False
        start = np.flatnonzero(inside & ~before)
        lens = np.diff(np.append(np.cumsum(inside)[start] - 1, np.count_nonzero(inside)))
        off = np.concatenate(([0], np.cumsum(lens))).astype(np.int64)
        col = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data[inside]))])
        coded = col.dictionary_encode()
        self.words = coded.dictionary
        self.ids = coded.indices.to_numpy().astype(np.int64)
        ends = _END[data]
        pieces = np.cumsum(ends)
        rows = np.searchsorted(cuts, start, "right")
        same = (pieces[start[1:]] == pieces[start[:-1]]) & (rows[1:] == rows[:-1])
        self.next = np.append(same, False)
        self.first = int(np.searchsorted(start, upto))

    def pointers(self, depth: int) -> np.ndarray:
        """One row per place: the ids of its word and the following ones in the piece, -1 beyond."""
        n = self.first
        out = np.full((n, depth), -1, np.int64)
        alive, at = np.ones(n, bool), np.arange(n)
        for d in range(depth):
            if d:
                alive = alive & self.next[np.minimum(at + d - 1, len(self.next) - 1)] & (at + d < len(self.ids))
            out[alive, d] = self.ids[at[alive] + d]
        return out


def stretches(batch, depth: int, cut: int) -> Iterator[tuple[str, Places]]:
    """The places of an Arrow batch ``(lang, text)``, one language at a time; long texts in parts."""
    import pyarrow as pa
    import pyarrow.compute as pc

    from cadenza.llm.common import text_bytes

    langs = pc.fill_null(batch.column("lang"), "und")
    texts = batch.column("text")
    for lang in pc.unique(langs).to_pylist():
        raw, off = text_bytes(texts.filter(pc.equal(langs, pa.scalar(lang, pa.string()))))
        lo, n = 0, len(off) - 1
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + cut, "right")) - 1)
            hi = min(hi, n)
            part, cuts = raw[off[lo]:off[hi]], off[lo:hi] - off[lo]
            if hi == lo + 1 and len(part) > cut:
                for piece, upto in _slices(part, depth, cut):
                    yield lang, Places(piece, np.zeros(1, np.int64), upto)
            elif len(part):
                yield lang, Places(part, cuts[cuts < len(part)], len(part))
            lo = hi


def _counted(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows once, with their counts."""
    if not len(p):
        return p, np.zeros(0, np.int64)
    width, most = p.shape[1], int(p.max()) + 2
    if most ** width < 1 << 63:
        key = np.zeros(len(p), np.int64)
        for d in range(width):
            key = key * most + (p[:, d] + 1)
        key, count = np.unique(key, return_counts=True)
        out = np.empty((len(key), width), np.int64)
        for d in range(width - 1, -1, -1):
            out[:, d] = key % most - 1
            key = key // most
        return out, count
    return np.unique(p, axis=0, return_counts=True)


def _statistics(batches, cut: int, hot_parts: int):
    """Pass 1: ``(lang, words, n, f)``: words with their counts, and pairs above their share of the stretch."""
    import pyarrow as pa

    for batch in batches:
        total: dict[tuple, int] = defaultdict(int)
        pairs: dict[tuple, int] = defaultdict(int)
        for lang, places in stretches(batch, 2, cut):
            names = places.words.to_pylist()
            own = np.bincount(places.ids[:places.first], minlength=len(names))
            for w, f in zip(names, own.tolist()):
                if f:
                    total[lang, w] += f
            p = places.pointers(2)
            p, f = _counted(p[p[:, 1] >= 0])
            heavy = f * hot_parts >= max(places.first, 1)
            heavy &= f > 1
            for (a, b), f in zip(p[heavy].tolist(), f[heavy].tolist()):
                pairs[lang, names[a] + b" " + names[b]] += f
        rows = [(*k, 1, f) for k, f in total.items()] + [(*k, 2, f) for k, f in pairs.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1].decode() for r in rows], pa.string()),
             pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int64())],
            names=["lang", "phrase", "n", "f"])


def _word_hashes(words) -> np.ndarray:
    """A 64-bit hash of every distinct word; it only deals the pointers."""
    off = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[off[0]:off[-1]].astype(np.uint64)
    off = off - off[0]
    if not len(data):
        return np.zeros(len(words), np.uint64)
    lens = np.diff(off)
    powers = np.cumprod(np.full(int(lens.max()), _ODD, np.uint64))
    at = np.arange(len(data)) - np.repeat(off[:-1], lens)
    return mix64(np.add.reduceat((data + np.uint64(1)) * powers[at], off[:-1]))


def _lines(p: np.ndarray, words):
    """Every pointer's words as one line of text, in order: a large binary array."""
    import pyarrow as pa
    import pyarrow.compute as pc

    cols = [words.take(pa.array(p[:, d], mask=p[:, d] < 0)) for d in range(p.shape[1])]
    joined = pc.binary_join_element_wise(*cols, pa.scalar(b" ", pa.large_binary()), null_handling="skip")
    return pc.binary_join_element_wise(joined, pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))


def _joined(column, edges: np.ndarray):
    """Neighbouring values from edge to edge as one value: new offsets over the same bytes."""
    import pyarrow as pa

    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(np.ascontiguousarray(off[edges])), column.buffers()[2]])


def _routed(batches, depth: int, cut: int, buckets: int, hot: dict[str, set]):
    """Pass 2: packed blocks by bucket, and the hot pairs' own counts (bucket null)."""
    import pyarrow as pa

    for batch in batches:
        pairs: dict[tuple, int] = defaultdict(int)
        for lang, places in stretches(batch, depth, cut):
            p = places.pointers(depth)
            p, count = _counted(p[p[:, 1] >= 0])
            if not len(p):
                continue
            h = _word_hashes(places.words)
            salt = np.uint64(int.from_bytes(lang.encode()[:8].ljust(8, b"\0"), "little"))
            key = mix64(h[p[:, 0]] * _ODD + mix64(h[p[:, 1]] + salt))
            is_hot = np.zeros(len(p), bool)
            if lang in hot:
                names, own = {}, hot[lang]
                for i, w in enumerate(places.words.to_pylist()):
                    names[w] = i
                codes = [names[a] * len(names) + names[b] for a, b in own if a in names and b in names]
                is_hot = np.isin(p[:, 0] * len(names) + p[:, 1], np.array(codes, np.int64))
                back = list(names)
                mine, at = np.unique(p[is_hot, 0] * len(names) + p[is_hot, 1], return_inverse=True)
                for code, f in zip(mine.tolist(), np.bincount(at, count[is_hot]).astype(np.int64).tolist()):
                    pairs[lang, back[code // len(names)] + b" " + back[code % len(names)]] += f
                third = np.where(p[:, 2] >= 0, h[p[:, 2]], np.uint64(0)) if depth > 2 else np.uint64(0)
                key = np.where(is_hot, mix64(key + third), key)
            keep = ~is_hot | (p[:, 2] >= 0) if depth > 2 else ~is_hot
            p, count, key, is_hot = p[keep], count[keep], key[keep], is_hot[keep]
            if not len(p):
                continue
            bucket = (key % np.uint64(buckets)).astype(np.int64) * 2 + is_hot
            order = np.argsort(bucket, kind="stable")
            p, count, bucket = p[order], count[order].astype("<i8"), bucket[order]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
            n = len(edges) - 1
            counts = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(edges * 8), pa.py_buffer(count)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[edges[:-1]] >> 1), pa.array((bucket[edges[:-1]] & 1).astype(bool)), pa.array([lang] * n, pa.string()),
                 _joined(_lines(p, places.words), edges).cast(pa.binary()), counts.cast(pa.binary()), pa.nulls(n, pa.string()),
                 pa.nulls(n, pa.int64())], names=ROUTED)
        n = len(pairs)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), pa.array([k[0] for k in pairs], pa.string()), pa.nulls(n, pa.binary()),
             pa.nulls(n, pa.binary()), pa.array([k[1].decode() for k in pairs], pa.string()), pa.array(list(pairs.values()), pa.int64())],
            names=ROUTED)


ROUTED = ["bucket", "hot", "lang", "lines", "counts", "phrase", "f"]
ROUTED_TYPE = "bucket bigint, hot boolean, lang string, lines binary, counts binary, phrase string, f bigint"


def multikey_sort(ids: np.ndarray, weight: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Three-way partitions of pointers, word by word: ``(pointer, count, depth)`` of every equal
    partition of ``least`` or more. All partitions of a round are split side by side.

    ``ids``: a row per pointer, -1 behind its last word. Every round takes a pivot in each open
    partition and moves its pointers to less, equal and greater (a counting move within the
    partition). Equal partitions go on with the next word, the others with the same; a partition
    whose counts add up to less than ``least`` is abandoned.
    """
    n, depth = ids.shape
    at, w = np.arange(n), weight.astype(np.int64)
    start, level = np.zeros(1 if n else 0, np.int64), np.zeros(1 if n else 0, np.int64)
    while len(start):
        size = np.diff(np.append(start, len(at)))
        seg = np.repeat(np.arange(len(start)), size)
        key = ids[at, level[seg]]
        pivot = key[start + size // 2]
        side = (key >= pivot[seg]).astype(np.int8) + (key > pivot[seg])
        code = seg * 3 + side
        total = np.bincount(code, w, minlength=3 * len(start)).astype(np.int64)
        count = np.bincount(code, minlength=3 * len(start))
        # the counting move: a pointer's place is its side's start and its rank within the side
        place = np.empty(len(at), np.int64)
        first = np.concatenate(([0], np.cumsum(count)[:-1]))
        for s in range(3):
            mine = np.flatnonzero(side == s)
            rank = np.arange(len(mine))
            begin = np.concatenate(([0], np.cumsum(count[s::3])[:-1]))
            place[mine] = first[code[mine]] + rank - begin[seg[mine]]
        moved, heavy = np.empty_like(at), np.empty_like(w)
        moved[place], heavy[place] = at, w
        parts = np.arange(3 * len(start))
        equal, deep = parts % 3 == 1, np.repeat(level, 3)
        good = total >= least
        found = equal & good & (np.repeat(pivot, 3) >= 0)
        if found.any():
            f = np.flatnonzero(found)
            for d in range(depth):
                own = f[deep[f] == d]
                if len(own):
                    yield moved[first[own]], total[own], d + 1
        go = good & (~equal | (found & (deep + 1 < depth)))
        keep = np.repeat(go, count)
        at, w = moved[keep], heavy[keep]
        level = deep[go] + equal[go]
        sizes = count[go]
        start = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else np.zeros(0, np.int64)


def _sorted_phrases(blocks: list[tuple], depth: int, least: int, hot: bool):
    """The phrases of one bucket and language: its words become numbers, then pointers are sorted."""
    import pyarrow as pa

    data = np.frombuffer(b"".join(b[0] for b in blocks), np.uint8)
    count = np.frombuffer(b"".join(b[1] for b in blocks), "<i8")
    ends = np.flatnonzero((data == 0x20) | (data == 0x0A))       # every word has one separator behind it
    line_end = data[ends] == 0x0A
    row = np.cumsum(line_end) - line_end
    at = np.arange(len(ends)) - np.append(0, np.flatnonzero(line_end)[:-1] + 1)[row]
    off = np.append(0, ends + 1 - np.arange(1, len(ends) + 1)).astype(np.int64)
    kept = np.ones(len(data), bool)
    kept[ends] = False
    words = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(off), pa.py_buffer(data[kept])]).dictionary_encode()
    ids = np.full((len(count), depth), -1, np.int32)
    ids[row, at] = words.indices.to_numpy()
    names = words.dictionary
    for p, f, d in multikey_sort(ids, count, least):
        if d < (3 if hot else 2):
            continue                  # single words, and hot pairs, are counted elsewhere
        text = names.take(pa.array(ids[p, :d].ravel())).to_pylist()
        yield [b" ".join(text[i:i + d]).decode() for i in range(0, len(text), d)], f.tolist(), d


def _bucket_phrases(batches, depth: int, least: int):
    """Pass 3: blocks arrive sorted by bucket and language."""
    import pyarrow as pa

    key, blocks = None, []

    def done():
        for text, f, d in _sorted_phrases(blocks, depth, least, key[1]):
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[2]] * len(text), pa.string()), pa.array(text, pa.string()),
                 pa.array([d] * len(text), pa.int32()), pa.array(f, pa.int64())], names=["lang", "phrase", "n", "f"])

    for batch in batches:
        for bucket, hot, lang, *block in zip(*(batch.column(c).to_pylist() for c in ROUTED[:5])):
            if key != (bucket, hot, lang):
                if blocks:
                    yield from done()
                key, blocks = (bucket, hot, lang), []
            blocks.append(block)
    if blocks:
        yield from done()


def phrase_counts(docs: DataFrame, max_words: int, least: int, tables: Tables | None = None) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, n, f)`` of all phrases of 1 to ``max_words`` words that occur ``least`` times
    or more in their language, and ``(lang, words)``: all word occurrences."""
    spark = docs.sparkSession
    bounded_batches(spark)
    cut, hot_parts = SLICE_BYTES, HOT_PARTS
    texts = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    grams = "lang string, phrase string, n int, f bigint"
    stats = written(texts.mapInArrow(lambda it: _statistics(it, cut, hot_parts), grams).groupBy("lang", "phrase", "n").agg(F.sum("f").alias("f")), "phrases-words", tables)
    size = stats.where("n = 1").groupBy("lang").agg(F.sum("f").alias("words"))
    total = stats.where("n = 1").agg(F.sum("f")).first()[0] or 0
    # pairs that hold over one in HOT_PARTS of all places: HOT_PARTS rows at most
    hot: dict[str, set] = defaultdict(set)
    for r in stats.where((F.col("n") == 2) & (F.col("f") * hot_parts > F.lit(total))).select("lang", "phrase").collect():
        hot[r["lang"]].add(tuple(r["phrase"].encode().split(b" ")))
    shared = spark.sparkContext.broadcast(dict(hot))
    buckets = n_blocks(total, BUCKET_POINTERS)
    routed = texts.mapInArrow(lambda it: _routed(it, max_words, cut, buckets, shared.value), ROUTED_TYPE)
    # blocks and the counts of hot pairs leave one pass together; the pairs are dealt by their text
    deal = F.coalesce(F.col("bucket"), F.pmod(F.xxhash64("lang", "phrase"), F.lit(buckets)))
    flow = (routed.withColumn("deal", deal).repartition(n_blocks(buckets, BUCKETS_PER_TASK), "deal")
            .sortWithinPartitions("bucket", "hot", "lang").select(ROUTED))
    found = flow.mapInArrow(lambda it: _phrases_and_pairs(it, max_words, least), grams)
    long = written(found.groupBy("lang", "phrase", "n").agg(F.sum("f").alias("f")).where(F.col("f") >= least), "phrases-long", tables)
    return stats.where((F.col("n") == 1) & (F.col("f") >= least)).unionByName(long), size


def _phrases_and_pairs(batches, depth: int, least: int):
    """Pass 3 with the hot pairs' partial counts, which sort before all blocks, passed on."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def blocks():
        for batch in batches:
            alone = pc.is_null(batch.column("bucket"))
            pairs = batch.filter(alone)
            if pairs.num_rows:
                waiting.append(pa.RecordBatch.from_arrays(
                    [pairs.column("lang"), pairs.column("phrase"), pa.array([2] * pairs.num_rows, pa.int32()), pairs.column("f")],
                    names=["lang", "phrase", "n", "f"]))
            yield batch.filter(pc.invert(alone))

    waiting: list = []
    for out in _bucket_phrases(blocks(), depth, least):
        yield from waiting
        waiting.clear()
        yield out
    yield from waiting


def collocations(docs: DataFrame, max_words: int = 3, least: int = 10, top: int = 2000, within: int = 50) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases of 2 to ``max_words`` words.

    A candidate occurs ``least`` times or more (``a``). A cut after its first k words scores
    ``floor(10^6 a^2 / (l r))`` with the counts of both parts; the lowest cut counts (ties: the
    smallest k). A candidate inside a longer one with ``100 f(longer) >= within * a`` is left out.
    A-Z are lower-cased; a null language is ``und``, a null text empty. Repeated rows count as
    often as they come; doc_id and other columns are not read. An empty table gives an empty
    result. Long texts are cut between words with the following words carried along, so the
    counts of a text do not depend on its length.
    """
    spark = docs.sparkSession
    if max_words < 2:
        return local_frame(spark, [], "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    grams, size = phrase_counts(docs, max_words, least)
    longs = grams.where("n >= 2").select("lang", "phrase", "n", F.col("f").alias("a"))
    word = F.split("phrase", " ")
    part = lambda lo, n: F.array_join(F.slice(word, lo, n), " ")
    cuts = longs.select("*", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("n") - F.col("k")).alias("right"))
    left = grams.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = grams.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    exact = lambda c: F.col(c).cast("decimal(15,0)")
    scored = (cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
              .withColumn("top", (exact("a") * exact("a") * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)"))
              .withColumn("bottom", (exact("l") * exact("r")).cast("decimal(38,0)"))
              .withColumn("score", F.expr("top div bottom").cast("bigint")))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("m")).select("lang", "phrase", "m.*")
    # the largest count of a longer candidate around each phrase
    inner = longs.where("n > 2").select("lang", F.col("a").alias("longer"), F.explode(F.expr(
        "flatten(transform(sequence(2, n - 1), k -> transform(sequence(1, n - k + 1), i -> array_join(slice(split(phrase, ' '), i, k), ' '))))"
    )).alias("phrase"))
    around = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = (best.join(around, ["lang", "phrase"], "left")
            .where(F.coalesce(100 * F.col("longer") < within * F.col("a"), F.lit(True))))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # the first of every salt, then the first of those: no language's candidates meet in one task
    salt = F.pmod(F.xxhash64("phrase"), F.lit(64))
    kept = (kept.withColumn("salt", salt).withColumn("at", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
            .where(F.col("at") <= top)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
            .where(F.col("rank") <= top))
    return (kept.join(size.withColumnRenamed("words", "n"), "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
