"""Line dedup (operator 9): a deletion-neighbourhood join of lines.

A line is a newline-separated part of a text, compared without outer white space. Lines of
fewer than ``MIN_WORDS`` words (parted by ASCII white space) say too little to be copies and always stay. Of two lines
within one character edit the earlier, by (doc_id, line number), stays: a line goes if an
earlier line within the bound exists.

1. Equal lines meet by hash; the first place of every distinct line is kept with it.
2. Two different lines within one edit agree in their first or their last half (of the
   shorter one's length). Halves are joined by hash; only lines that share one go on.
3. Of those, every variant with one character deleted is emitted as a hashed key, within the
   half in which the lines may differ. Lines that delete the same position to the same
   variant differ by a substitution; a line equal to another's variant differs by a deletion.
   The earliest line of a key stands for all its lines, so no pairs of a group are listed.
4. The edit distance of every line and its earlier partner is verified on the texts.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import Tables, bounded_batches, broadcast_if_small, row_keys, written

MIN_WORDS = 5
#: Rows and line numbers of a broadcast list of lost lines at most.
BROADCAST_LINES = 4_000_000
_SPACE = " \t\n\x0b\x0c\r"


def _hash(text: str, seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed)


def _signed(values) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def text_lines(text: str | None):
    """(line number, compared form) of the lines that take part."""
    for no, line in enumerate((text or "").split("\n")):
        line = line.strip(_SPACE)
        if len(line.encode("utf-8", "surrogatepass").split(None, MIN_WORDS - 1)) >= MIN_WORDS:
            yield no, line


def halves(line: str):
    """(anchor, start, end): what is outside ``start..end`` is hashed into the anchor.

    Two lines of length n, or one of n and one of n + 1, share an anchor of base n if they
    agree outside that half.
    """
    n = len(line)
    for base in (n, n - 1):
        mid = base // 2
        yield _hash(line[n - (base - mid):], 4 * base), 0, n - (base - mid)
        yield _hash(line[:mid], 4 * base + 1), mid, n


def deletion_keys(line: str, anchor: int, start: int, end: int):
    """(key, role) of a line's variants within ``start..end``.

    Role 0: the variant with its position, met by lines with another character there. Role 1:
    the variant. Role 2: the line itself, met by the variants of longer lines.
    """
    part = line[start:end]
    yield _hash(part, anchor), 2
    for i in range(len(part)):
        variant = _hash(part[:i] + part[i + 1:], anchor)
        yield (variant ^ (0x9E3779B97F4A7C15 * (i + 1))) & (2 ** 64 - 1), 0
        if not i or part[i] != part[i - 1]:     # within a run every deletion gives the same variant
            yield variant, 1


def _anchors(batches):
    import pyarrow as pa

    for batch in batches:
        ids, rows, nos, hs, off, anchors = [], [], [], [], [0], []
        for doc, row, text in zip(batch.column("doc_id").to_pylist(), batch.column("r1").to_pylist(), batch.column("text")):
            for no, line in text_lines(text.as_py()):
                ids.append(doc)
                rows.append(row)
                nos.append(no)
                hs.append(_hash(line))
                anchors.extend(a for a, _, _ in halves(line))
                off.append(len(anchors))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(nos, pa.int64()), pa.array(_signed(hs)),
             pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(_signed(anchors)))],
            names=["doc_id", "r1", "line_no", "h", "anchors"])


def _candidates(batches):
    """The candidates' lines, each from its first place."""
    import pyarrow as pa

    for batch in batches:
        out = {}
        for doc, text, want in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "lines"))):
            want = {x["line_no"]: x["h"] for x in want}
            for no, line in text_lines(text):
                if no in want and int(_signed([_hash(line)])[0]) == want[no]:
                    out[want[no], doc, no] = line
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in out], pa.int64()) for i in range(3)] + [pa.array(list(out.values()), pa.string())],
            names=["h", "doc_id", "line_no", "line"])


def _variants(batches):
    """Rows (h, doc_id, line_no, line, shared): deletion keys within the shared halves."""
    import pyarrow as pa

    names = ["key", "role", "h", "doc_id", "line_no"]

    def packed(keys, roles, own):
        return pa.RecordBatch.from_arrays(
            [pa.array(_signed(keys)), pa.array(roles, pa.int32())]
            + [pa.array([o[i] for o in own], pa.int64()) for i in range(3)], names=names)

    for batch in batches:
        keys, roles, own = [], [], []
        for h, doc, no, line, shared in zip(*(batch.column(c).to_pylist()
                                              for c in ("h", "doc_id", "line_no", "line", "shared"))):
            shared = set(shared)
            for anchor, start, end in halves(line):
                if int(_signed([anchor])[0]) in shared:
                    for key, role in deletion_keys(line, anchor, start, end):
                        keys.append(key)
                        roles.append(role)
                        own.append((h, doc, no))
                        if len(keys) >= 50_000:
                            yield packed(keys, roles, own)
                            keys, roles, own = [], [], []
        if keys:
            yield packed(keys, roles, own)


def dropped_lines(docs: DataFrame, tables: Tables) -> DataFrame:
    """``(r1, lines)``: the line numbers that go, per document that loses any.

    Rows are known by a hash of id and text (``r1``), so other texts under one id are other places;
    equal rows count as one place. A null doc_id is the last of all ids.
    """
    bounded_batches(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = base.select("doc_id", "text", row_keys()[0])
    lines = base.mapInArrow(_anchors, "doc_id bigint, r1 bigint, line_no bigint, h bigint, anchors array<bigint>")
    lines = written(lines, "lines", tables)
    # a null id sorts last
    place = F.struct(F.col("doc_id").isNull().cast("int").alias("n"), "doc_id", "line_no", "r1")
    firsts = written(lines.groupBy("h").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("places"),
                                            F.first("anchors").alias("anchors")), "lines-first",
                     tables)
    gone = _near(base, firsts, tables)
    # only lines with several places, or gone ones, need a look at their places
    known = firsts.select("h", "first", "places").join(gone.select("h", F.lit(True).alias("gone")), "h", "left")
    known = known.where("places > 1 OR gone").select("h", "first", F.coalesce("gone", F.lit(False)).alias("gone"))
    known = written(known, "lines-known", tables)
    lost = (lines.select("r1", "line_no", "h").join(broadcast_if_small(known, known.count()), "h")
            .where(F.col("gone") | (F.col("r1") != F.col("first.r1")) | (F.col("line_no") != F.col("first.line_no"))))
    return lost.groupBy("r1").agg(F.collect_set("line_no").alias("lines"))


def _near(base: DataFrame, firsts: DataFrame, tables: Tables) -> DataFrame:
    """``(h)`` of the lines within one edit of an earlier, different line."""
    halves_of = firsts.select("h", F.explode("anchors").alias("anchor"))
    shared = (halves_of.groupBy("anchor").agg(F.min("h").alias("a"), F.max("h").alias("b"))
              .where("a <> b").select("anchor"))
    shared = written(shared, "lines-shared", tables)
    cand = halves_of.join(broadcast_if_small(shared, shared.count()), "anchor")
    cand = cand.groupBy("h").agg(F.collect_set("anchor").alias("shared"))
    cand = written(cand.join(firsts.select("h", "first"), "h"), "lines-cand", tables)
    wanted = cand.groupBy(F.col("first.r1").alias("r1")).agg(
        F.collect_list(F.struct(F.col("first.line_no").alias("line_no"), "h")).alias("lines"))
    wanted = written(wanted, "lines-wanted", tables)
    texts = (base.join(broadcast_if_small(wanted, wanted.count()), "r1")
             .select("doc_id", "text", "lines")
             .mapInArrow(_candidates, "h bigint, doc_id bigint, line_no bigint, line string"))
    texts = written(texts.dropDuplicates(["h"]), "lines-texts", tables)
    rows = texts.join(cand.select("h", "shared"), "h").mapInArrow(
        _variants, "key bigint, role int, h bigint, doc_id bigint, line_no bigint")
    order = F.struct(F.col("doc_id").isNull().cast("int"), "doc_id", "line_no", "h")
    rows = rows.select("key", "h", "role", order.alias("at"))
    group = Window.partitionBy("key")
    met = rows.withColumn("sub", F.min(F.when(F.col("role") == 0, F.col("at"))).over(group)) \
        .withColumn("cut", F.min(F.when(F.col("role") == 1, F.col("at"))).over(group)) \
        .withColumn("whole", F.min(F.when(F.col("role") == 2, F.col("at"))).over(group))
    partner = (F.when(F.col("role") == 0, F.col("sub")).when(F.col("role") == 1, F.col("whole"))
               .otherwise(F.col("cut")))
    pairs = (met.withColumn("partner", partner).where("partner < at")
             .select("h", F.col("partner.h").alias("p")).distinct())
    text = texts.select("h", "line")
    checked = (pairs.join(text, "h").join(text.select(F.col("h").alias("p"), F.col("line").alias("other")), "p")
               .where(F.levenshtein("line", "other", 1) >= 0))
    return written(checked.select("h").distinct(), "lines-gone", tables)


def line_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated lines, plus ``n_lines`` and ``n_removed`` (long).

    The other lines of a text, also blank and short ones, stay as they are and in order. A
    null text stays null, an empty one empty. Other columns keep their values; columns of the
    names ``n_lines`` and ``n_removed`` are replaced.
    """
    tables = Tables()
    lost = dropped_lines(docs, tables).select(F.col("r1").alias("_cz_id"), F.col("lines").alias("_cz_lines"))
    lost = written(lost, "lines-lost")
    tables.drop(docs.sparkSession)
    size = lost.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size("_cz_lines")), F.lit(0))).first()[0]
    row = F.xxhash64(docs["doc_id"].cast("bigint"), docs["text"].cast("string"))
    got = docs.join(broadcast_if_small(lost, size, BROADCAST_LINES), row == lost["_cz_id"], "left")
    parts = F.split("text", "\n", -1)
    numbers = F.sequence(F.lit(0).cast("bigint"), F.size(parts).cast("bigint") - 1)
    kept = F.transform(F.array_except(numbers, "_cz_lines"), lambda i: F.get(parts, i.cast("int")))
    text = F.when(F.col("_cz_lines").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return (got.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("bigint"))
            .withColumn("n_removed", F.when(F.col("_cz_lines").isNull(), 0).otherwise(F.size("_cz_lines")).cast("bigint"))
            .withColumn("text", text).drop("_cz_id", "_cz_lines"))
