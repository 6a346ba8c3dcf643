"""Mixture-controlled packing (operator 7): deficit round-robin over source queues.

A document is its token ids and an end id. Texts are tokenized where they are read; the ids are
dealt to tasks, and ordered within them, by a hash of the row, so that every task meets all
sources side by side whatever the order of the input. Every task reads its documents once and
queues them by source. It fills one window of ``WINDOW`` sequences after another: each source
earns its share of the window, and is served whole documents while its deficit (what it earned
and has not got) lasts; documents longer than a sequence are served in parts. Room that is left
goes to the queues with the largest deficits. Deficits carry over from window to window.
Sequences are cut from the stream of served documents, without gaps.

What is left at the end of a task (less than one sequence) goes on with the task's deficits to
a second round, in which tasks of ``TAIL_TASKS`` first-round tasks each pack the rest the same
way. Their last tokens are cut into sequences whose lengths are powers of two, which need no
padding.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import _SPACE, Tables, bounded_batches, n_blocks, text_bytes, written

SEQUENCE = 2048
#: Sequences in a window, and windows that a task buffers.
WINDOW, BUFFERED = 32, 4
END_ID = 1
#: Pieces that a task holds before it passes them on, about.
MOST_PIECES = 512
#: Bytes of text that a first-round task packs, about, and first-round tasks at most.
TASK_BYTES, MAX_TASKS = 8 << 20, 10_000
#: First-round tasks whose rest one second-round task packs.
TAIL_TASKS = 256
#: Queues at most; more sources share queues by hash.
MAX_QUEUES = 10_000
#: Words (and parts of words) that a worker remembers; bytes of text that are encoded at a time.
CACHE_WORDS, STRETCH = 500_000, 4 << 20

PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


#: A run of letters up to U+00FF and then ASCII punctuation: most words are of this form.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\\[-`{-~]*)")
#: ASCII punctuation.
_ENDS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_PROBES = ["The", "word,", "Zebra", "\u00c9t\u00e9", "na\u00efve.", "stra\u00dfe!!", "x###", "QUE%%%", "a", "anti-", "\u00f1andu)."]


class WordTokenizer:
    """Token ids of texts by their distinct words.

    Valid for tokenizers that split at white space and drop it, as the word vocabularies do: the
    ids of a text are those of its words in order. The words of a batch are numbered (exactly, by
    Arrow), every new one is encoded once, and Arrow puts the ids together. Words are
    remembered while they keep coming, so that common ones outlive a flood of rare ones.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import pyarrow as pa
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(spec)
        size = self.tokenizer.get_vocab_size()
        #: Bytes of an id: most vocabularies fit in 16 bits.
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.words, self.ids = pa.array([], pa.large_binary()), pa.array([], pa.large_binary())
        self.used, self.turn = np.zeros(0, np.int64), 0
        self.parts: dict[bytes, bytes] = {}
        self.model = self.tokenizer.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.as_bytes = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.id_bytes = [i.to_bytes(self.kind.itemsize, "little") for i in range(size)]
        gc.set_threshold(100_000, 50, 100)      # large dicts of bytes hold no cycles
        self.plain = True
        self.plain = all(self._ids(w.encode()) == self._encode(w) for w in _PROBES)

    def _encode(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, self.kind).tobytes()

    def _model_ids(self, text: str) -> bytes:
        tokens = self.model.tokenize(text if text.isascii() else text.translate(self.as_bytes))
        return b"".join([self.id_bytes[t.id] for t in tokens])

    def _part(self, part: bytes) -> bytes:
        """The ids of lower-case letters, or of punctuation, as part of a word."""
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) >= CACHE_WORDS:
                self.parts.clear()
            ids = self.parts[part] = self._model_ids(part.decode("utf-8"))
        return ids

    def _ids(self, word: bytes) -> bytes:
        """A word's ids. If the tokenizer lower-cases and splits letters from punctuation (which is
        tried on some words), only the parts of plain words go through the byte-pair model."""
        if self.plain:
            core = word.rstrip(_ENDS)
            if core.isalpha():
                if len(core) == len(word):
                    return self._model_ids(word.decode("ascii")) if word.islower() else self._part(word.lower())
                return self._part(core.lower()) + self._part(word[len(core):])
            if not word.isascii() and (form := _PLAIN.fullmatch(word.decode("utf-8"))):
                if not form[2]:
                    return self._model_ids(form[1].lower())
                return self._part(form[1].lower().encode()) + self._part(form[2].encode())
        return self._encode(word.decode("utf-8"))

    def _known(self, words):
        """The ids of distinct words: those remembered are found by Arrow, the new ones are encoded
        and remembered in place of the ones not met for longest."""
        import pyarrow as pa
        import pyarrow.compute as pc

        self.turn += 1
        at = pc.index_in(words, value_set=self.words)
        self.used[pc.drop_null(at).to_numpy()] = self.turn
        ids, missing = self.ids.take(at), pc.is_null(at)
        new = words.filter(missing)
        if len(new):
            got = pa.array([self._ids(w) for w in new.to_pylist()], pa.large_binary())
            ids = pc.replace_with_mask(ids, missing, got)
            self.words, self.ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, got])
            self.used = np.append(self.used, np.full(len(new), self.turn))
            if len(self.used) > CACHE_WORDS:
                keep = np.sort(np.argsort(self.used, kind="stable")[len(self.used) - CACHE_WORDS // 2:])
                self.words, self.ids, self.used = self.words.take(pa.array(keep)), self.ids.take(pa.array(keep)), self.used[keep]
        return ids

    def encode(self, column) -> Iterator[bytes]:
        """The ids (``kind``) of every text of an Arrow column, with the end id; long columns in
        stretches of texts of about ``STRETCH`` bytes, long texts in parts that end between words."""
        data, offsets = text_bytes(column)
        lo, n = 0, len(offsets) - 1
        while lo < n:
            hi = min(max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + STRETCH, "right")) - 1), n)
            if hi == lo + 1 and offsets[hi] - offsets[lo] > 2 * STRETCH:
                yield self._long(data[offsets[lo]:offsets[hi]])
            else:
                yield from self._stretch(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], True)
            lo = hi

    def _long(self, data: np.ndarray) -> bytes:
        parts, lo = [], 0
        while lo < len(data):
            hi = min(lo + STRETCH, len(data))
            while hi < len(data) and not _SPACE[data[hi]]:
                space = _SPACE[data[hi:hi + STRETCH]]
                hi += int(space.argmax()) if space.any() else len(space)
            parts += self._stretch(data[lo:hi], np.array([0, hi - lo]), False)
            lo = hi
        return b"".join(parts) + np.array([END_ID], self.kind).tobytes()

    def _stretch(self, data: np.ndarray, offsets: np.ndarray, end: bool) -> Iterator[bytes]:
        import pyarrow as pa

        rows = len(offsets) - 1
        inside = ~_SPACE[data]
        before = np.zeros_like(inside)
        before[1:] = inside[:-1]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        start = np.flatnonzero(inside & ~before)
        row = np.searchsorted(offsets, start, "right") - 1
        kept = data[inside]
        off = np.append(np.cumsum(inside)[start] - 1, len(kept)).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(off), pa.py_buffer(kept)]).dictionary_encode()
        known = self._known(coded.dictionary).take(coded.indices)
        # the ids of the words in order stand side by side: cut them where texts begin
        at = np.frombuffer(known.buffers()[1], np.int64)[known.offset:known.offset + len(known) + 1]
        ids = memoryview(known.buffers()[2] or b"")
        cuts = at[np.searchsorted(row, np.arange(rows + 1))].tolist() if len(known) else [0] * (rows + 1)
        last = END_ID.to_bytes(self.kind.itemsize, "little") if end else b""
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield bytes(ids[lo:hi]) + last


_TOKENIZERS: dict[int, WordTokenizer] = {}


def tokenizer_of(spec: str) -> WordTokenizer:
    """One tokenizer (and word cache) per Python worker and vocabulary."""
    key = zlib.crc32(spec.encode())
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = WordTokenizer(spec)
    return _TOKENIZERS[key]


class Packer:
    """Source queues, deficits, and the sequences cut so far."""

    def __init__(self, shares: dict, base: int):
        self.shares, self.base = shares, base
        self.queues: dict[str, deque] = defaultdict(deque)
        self.deficit: dict[str, float] = defaultdict(float)
        self.buffered, self.sequences, self.stream, self.out = 0, 0, [], []
        self.streamed = 0

    def add(self, queue: str, doc_id, ids: bytes, start: int, total: int) -> None:
        self.queues[queue].append([doc_id, ids, start, total])
        self.buffered += len(ids) // 4

    def _serve(self, queue: str, most: int) -> int:
        """Move ``most`` tokens at most of the queue's first document to the stream."""
        head = self.queues[queue][0]
        n = min(len(head[1]) // 4, most)
        self.stream.append((head[0], head[1][:4 * n], head[2], head[3], queue))
        if 4 * n == len(head[1]):
            self.queues[queue].popleft()
            if not self.queues[queue]:
                del self.queues[queue]
        else:
            head[1], head[2] = head[1][4 * n:], head[2] + n
        self.deficit[queue] -= n
        self.buffered -= n
        self.streamed += n
        return n

    def fill(self, tokens: int) -> None:
        """One window: deal the shares, serve by deficit, then by largest deficit."""
        for queue, share in self.shares.items():
            self.deficit[queue] += share * tokens
        room = tokens
        for queue in sorted(self.queues):
            while room and queue in self.queues:
                size, credit = len(self.queues[queue][0][1]) // 4, int(self.deficit[queue])
                if size > credit:
                    size = credit // SEQUENCE * SEQUENCE if size > SEQUENCE else 0
                if size <= 0:
                    break
                room -= self._serve(queue, min(size, room))
        while room and self.queues:
            queue = max(self.queues, key=lambda q: (self.deficit[q], q))
            room -= self._serve(queue, min(room, SEQUENCE))
        self.cut(SEQUENCE)

    def cut(self, size: int) -> None:
        """Cut the stream into as many sequences of ``size`` tokens as it holds."""
        while self.streamed >= size:
            offset, rest, keep = 0, [], iter(self.stream)
            for doc_id, ids, start, total, queue in keep:
                n = min(len(ids) // 4, size - offset)
                if n:
                    self.out.append((doc_id, start, ids[:4 * n], total, self.base + self.sequences, offset))
                offset += n
                if 4 * n < len(ids):
                    rest.append((doc_id, ids[4 * n:], start + n, total, queue))
                if offset == size:
                    break
            self.stream = rest + list(keep)
            self.streamed -= size
            self.sequences += 1

    def rows(self, with_ids: bool):
        import pyarrow as pa

        out, self.out = self.out, []
        cols = [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                pa.array([len(r[2]) // 4 for r in out], pa.int64()),
                pa.array([zlib.crc32(r[2]) for r in out], pa.int64()), pa.array([r[3] for r in out], pa.int64()),
                pa.array([r[4] for r in out], pa.int64()), pa.array([r[5] for r in out], pa.int64())]
        ids = None
        if with_ids:
            off = np.concatenate(([0], np.cumsum([len(r[2]) // 4 for r in out]))).astype(np.int32)
            flat = np.frombuffer(b"".join(r[2] for r in out), "<u4").astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(off), pa.array(flat))
        return cols, ids


def _token_rows(batches, spec: str):
    """``(doc_id, queue, ids)``: the ids of every document with the end id, as bytes."""
    import pyarrow as pa

    model = tokenizer_of(spec)
    for batch in batches:
        ids = pa.array(list(model.encode(batch.column("text"))), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("queue"), ids], names=["doc_id", "queue", "ids"])


def _first_round(batches, kind: str, shares: dict, with_ids: bool):
    """Whole windows of a task's documents; what is left as rows with ids, queue and deficit."""
    import pyarrow as pa
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    pack = Packer(shares, task << 32)

    def done():
        cols, ids = pack.rows(with_ids)
        n = len(cols[0])
        none = [pa.nulls(n, t) for t in (pa.int64(), pa.string(), pa.float64(), pa.binary())]
        return pa.RecordBatch.from_arrays(
            cols + none + ([ids] if with_ids else []), names=NAMES + (["ids"] if with_ids else []))

    for batch in batches:
        for queue, doc_id, ids in zip(*(batch.column(c).to_pylist() for c in ("queue", "doc_id", "ids"))):
            ids = np.frombuffer(ids, kind).astype("<u4").tobytes()
            pack.add(queue, doc_id, ids, 0, len(ids) // 4)
            while pack.buffered >= BUFFERED * WINDOW * SEQUENCE:
                pack.fill(WINDOW * SEQUENCE)
            if len(pack.out) >= MOST_PIECES:
                yield done()
    while pack.buffered >= WINDOW * SEQUENCE:
        pack.fill(WINDOW * SEQUENCE)
    if pack.buffered:
        pack.fill(pack.buffered)
    if pack.out:
        yield done()
    # the rest, with the deficit of each queue on its first row; a queue without rest has an empty one
    deficit = dict(pack.deficit)
    rest = [(task, doc_id, ids, start, total, queue, deficit.pop(queue, 0.0))
            for doc_id, ids, start, total, queue in pack.stream]
    rest += [(task, None, b"", 0, 0, queue, d) for queue, d in deficit.items()]
    if rest:
        n = len(rest)
        cols = [pa.array([r[1] for r in rest], pa.int64()), pa.array([r[3] for r in rest], pa.int64()),
                pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([r[4] for r in rest], pa.int64()),
                pa.nulls(n, pa.int64()), pa.array(range(n), pa.int64()), pa.array([r[0] for r in rest], pa.int64()),
                pa.array([r[5] for r in rest], pa.string()), pa.array([r[6] for r in rest], pa.float64()),
                pa.array([r[2] for r in rest], pa.binary())]
        more = [pa.nulls(n, pa.list_(pa.int32()))] if with_ids else []
        yield pa.RecordBatch.from_arrays(cols + more, names=NAMES + (["ids"] if with_ids else []))


NAMES = [c.split()[0] for c in PIECE.split(", ")] + ["task", "queue", "deficit", "rest"]
FIRST = PIECE + ", task bigint, queue string, deficit double, rest binary"


def _second_round(batches, shares: dict, with_ids: bool):
    """Rows sorted by block of tasks: each block's rest is packed by the same rules."""
    import pyarrow as pa

    block, pack = None, None

    def done():
        cols, ids = pack.rows(with_ids)
        return pa.RecordBatch.from_arrays(cols + ([ids] if with_ids else []),
                                          names=NAMES[:7] + (["ids"] if with_ids else []))

    def end():
        while pack.buffered >= WINDOW * SEQUENCE:
            pack.fill(WINDOW * SEQUENCE)
        if pack.buffered:
            pack.fill(pack.buffered)
        size = SEQUENCE
        while pack.streamed:
            if pack.streamed >= size:
                pack.cut(size)
            size //= 2
        return done()

    for batch in batches:
        for b, doc_id, start, total, queue, deficit, ids in zip(
                *(batch.column(c).to_pylist() for c in ("block", "doc_id", "start", "doc_tokens", "queue", "deficit", "rest"))):
            if b != block:
                if pack is not None:
                    yield end()
                block, pack = b, Packer(shares, (1 << 30) + b << 32)
            pack.deficit[queue] += deficit
            if ids:
                pack.add(queue, doc_id, ids, start, total)
        while pack is not None and pack.buffered >= BUFFERED * WINDOW * SEQUENCE:
            pack.fill(WINDOW * SEQUENCE)
    if pack is not None:
        yield end()


def dealt(flow: DataFrame, tasks: int) -> DataFrame:
    """``flow`` in ``tasks`` partitions, dealt and ordered by a hash of the whole row."""
    return (flow.withColumn("deal", F.xxhash64("doc_id", "queue", "ids")).repartition(tasks, "deal")
            .sortWithinPartitions("deal").drop("deal"))


def pack(docs: DataFrame, tokenizer_path: str, shares: dict[str, float] | None = None,
         with_ids: bool = False) -> DataFrame:
    """The pieces of all documents: ``(doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset)`` and, ``with_ids``, the piece's ``ids``.

    ``shares``: target share of every source's tokens in each window (null source: empty
    string); sources without one wait until room is left. By default each source's share of
    all tokens, so that queues run dry together. All documents are packed in the end. Null and
    empty texts are documents of the end id alone. Repeated rows are packed as often as they
    come; a null doc_id stays null. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    kind, spec = WordTokenizer(text).kind.str, spark.sparkContext.broadcast(text)    # a vocabulary file
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    named = docs.select("source").distinct().limit(MAX_QUEUES + 1).count()
    queue = source if named <= MAX_QUEUES else F.pmod(F.xxhash64(source), F.lit(MAX_QUEUES)).cast("string")
    flow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       queue.alias("queue"))
    size = flow.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    tokens = flow.mapInArrow(lambda it: _token_rows(it, spec.value), "doc_id bigint, queue string, ids binary")
    flow, tables = dealt(tokens, min(n_blocks(size, TASK_BYTES), MAX_TASKS)), Tables()
    flow = written(flow, "pack-tokens", tables)
    sizes = {r["queue"]: r["n"] for r in flow.groupBy("queue").agg(F.sum(F.octet_length("ids").cast("bigint")).alias("n")).collect()}
    total = sum(sizes.values())
    shares = shares if shares is not None else {q: n / total for q, n in sizes.items()}
    ids = ", ids array<int>" if with_ids else ""
    first = written(flow.mapInArrow(lambda it: _first_round(it, kind, shares, with_ids), FIRST + ids), "pack")
    tables.drop(spark)
    rest = (first.where("rest IS NOT NULL")
            .withColumn("block", F.floor(F.col("task") / F.lit(TAIL_TASKS)).cast("bigint"))
            .select("block", "task", F.col("offset").alias("nth"), "doc_id", "start", "doc_tokens", "queue", "deficit", "rest")
            .repartition("block").sortWithinPartitions("block", "task", "nth"))
    second = rest.mapInArrow(lambda it: _second_round(it, shares, with_ids), PIECE + ids)
    return first.where("rest IS NULL").select(second.columns).unionByName(second)
