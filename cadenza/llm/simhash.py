"""Document fingerprints (operator 6): SimHash and permuted block tables, DataFrame functions only.

Every pair of neighbouring words (and the last word alone) is a term, weighted by its
occurrences. Each bit of a term's 64-bit hash votes for or against that bit of the
fingerprint; more votes for than against set it. Two counts share one 64-bit sum, so a text
needs 32 sums.

Fingerprints within ``radius`` bits of each other agree in at least ``blocks - radius`` of
``blocks`` blocks of bits. For every choice of that many blocks there is one table with those
bits in front; equal fronts are joined and the distance is checked, so all are found.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import broadcast_if_small, n_blocks, written

WORD = r"[^\x20\x09-\x0D]+"
BITS = 64
RADIUS, BLOCKS = 3, 5
#: Documents in a range of ids, and ranges at most (a range is what one task sorts).
RANGE_ROWS, MAX_RANGES = 1_500, 40_000


def _votes(words: Column, at: Column) -> list[Column]:
    """32 sums; each counts the set bits i (low half) and i + 32 (high half) of the terms."""
    term = F.xxhash64(F.get(words, at), F.get(words, at + 1))
    pair = F.lit((1 << 32) | 1).cast("bigint")
    return [F.sum(F.when(at.isNotNull(), F.shiftrightunsigned(term, i).bitwiseAND(pair))).alias(f"v{i}")
            for i in range(BITS // 2)]


def _bits(terms: str = "terms") -> Column:
    """The fingerprint as a long: bit i is set if more than half of the terms have it."""
    low = F.lit((1 << 32) - 1).cast("bigint")
    fp = F.lit(0).cast("bigint")
    for i in range(BITS // 2):
        v = F.coalesce(f"v{i}", F.lit(0).cast("bigint"))
        for bit, ones in ((i, v.bitwiseAND(low)), (i + 32, F.shiftrightunsigned(v, 32))):
            fp = fp.bitwiseOR(F.shiftleft((ones * 2 > F.col(terms)).cast("bigint"), bit))
    return fp


def simhash(texts: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """``key`` columns and ``fp`` (long) of every row; ``key`` tells the rows apart.

    Null and empty texts, and texts without words, have fingerprint 0. The words of a row
    are exploded and summed within its task if the rows are partitioned by part of the key.
    """
    rows = texts.select(*key, F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0)).alias("words"))
    every = F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1))
    rows = rows.select(*key, "words", F.explode_outer(every).alias("at"))
    votes = rows.groupBy(*key).agg(F.count("at").alias("terms"), *_votes(F.col("words"), F.col("at")))
    return votes.select(*key, _bits().alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))


def masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """The front bits of every table, as masks (signed longs)."""
    edges = [i * BITS // blocks for i in range(blocks + 1)]
    out = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def within_radius(index: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``(fp, query_fp)``: all pairs within ``radius`` bits, equal ones too, each once.

    Both tables hold distinct fingerprints ``fp``, so copies are never listed.
    """
    fronts = [F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("front"))
              for i, m in enumerate(masks(radius, blocks))]

    def tables(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("fp").alias(name), F.explode(F.array(*fronts)).alias("x")).select(name, "x.t", "x.front")

    met = tables(index, "fp").join(tables(queries, "query_fp"), ["t", "front"])
    return met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("query_fp"))) <= radius).select("fp", "query_fp").distinct()


def with_next_text(docs: DataFrame) -> DataFrame:
    """``(rng, rn, guest, doc_id, text, next_text)``: every document and its successor.

    Documents ascend by doc_id (nulls first, equal ids by a hash of the text); the last one's
    successor is the first. Ranges of ids are sorted in parallel: each also gets the first
    document of the next range as a guest, so no row needs another range. One shuffle.
    """
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = base.agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("ids"), F.min("doc_id").alias("low")).first()
    ranges = min(n_blocks(rows["n"], RANGE_ROWS), MAX_RANGES)
    # the first id of each range, as a sorted list that is constant in the plan
    cuts = [] if rows["low"] is None else base.agg(F.percentile_approx(
        "doc_id", F.lit([i / ranges for i in range(ranges)]), F.lit(max(10_000, 20 * ranges)))).first()[0]
    cuts = sorted({*cuts, rows["low"]} - {None})
    last, nulls = len(cuts), rows["n"] > rows["ids"]
    step = max(1, int(len(cuts) ** 0.5))

    def constant(values) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")

    if cuts:
        # two steps: among every step-th cut first, then among those that follow
        coarse = F.size(F.filter(constant(cuts[::step]), lambda b: b <= F.col("doc_id")))
        near = F.slice(constant(cuts), F.greatest((coarse - 1) * step + 1, F.lit(1)), step)
        rng = F.when(F.col("doc_id").isNull(), 0).otherwise(
            F.greatest(coarse - 1, F.lit(0)) * step + F.size(F.filter(near, lambda b: b <= F.col("doc_id"))))
        first = F.col("doc_id").eqNullSafe(F.get(constant(cuts), F.col("rng") - 1)) | F.col("doc_id").isNull()
    else:
        rng, first = F.lit(0), F.lit(True)
    before = F.when(F.col("rng") > 1, F.col("rng") - 1).when(
        (F.col("rng") == 1) & F.lit(nulls), F.lit(0)).otherwise(F.lit(last))
    places = F.when(first, F.array(F.struct(F.col("rng").alias("rng"), F.lit(0).alias("guest")),
                                   F.struct(before.alias("rng"), F.lit(1).alias("guest")))).otherwise(
        F.array(F.struct(F.col("rng").alias("rng"), F.lit(0).alias("guest"))))
    dealt = (base.withColumn("rng", rng.cast("int")).withColumn("place", F.explode(places))
             .select("place.rng", "place.guest", "doc_id", "text"))
    dealt = dealt.repartition("rng")
    order = Window.partitionBy("rng").orderBy("guest", F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    return dealt.select("*", F.row_number().over(order).alias("rn"), F.lead("text").over(order).alias("next_text"))


def fingerprint_table(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are.

    The edited text has its last floor(n / 2) characters replaced by the first as many of the
    next document. ``near_queries``: how many other documents, of those whose id is divisible
    by 50, have a fingerprint within ``RADIUS`` bits. Null texts are empty; two empty texts
    are wholly alike. Repeated rows are documents of their own; null ids come first.
    """
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    rows = with_next_text(docs)
    edited = F.concat(F.left("text", n - half), F.coalesce(F.left("next_text", half), F.lit("")))
    rows = rows.select("rng", "rn", "guest", "doc_id", n.cast("bigint").alias("n_chars"), "text", edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.when(F.col("guest") == 0, F.sha2("edited", 256)))
    both = F.array(F.struct(F.lit(0).alias("which"), "text"), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))
    keys = ["rng", "rn", "guest", "doc_id", "n_chars", "edited_sha256"]
    flow = rows.select(*keys, F.explode(F.when(F.col("guest") == 0, both).otherwise(F.slice(both, 1, 1))).alias("x"))
    fps = simhash(flow.select(*keys, "x.which", "x.text"), [*keys, "which"])
    own = fps.groupBy(*keys).agg(F.max(F.when(F.col("which") == 0, F.col("fp"))).alias("fp"),
                                 F.max(F.when(F.col("which") == 1, F.col("fp"))).alias("edited_fp"))
    own = own.withColumn("next_fp", F.lead("fp").over(Window.partitionBy("rng").orderBy("rn")))
    own = written(own.where("guest = 0").drop("guest", "rng", "rn"), "simhash")

    asked = F.coalesce(F.col("doc_id") % 50 == 0, F.lit(False))
    index = own.groupBy("fp").agg(F.count_if(asked).alias("asked"))
    index = written(index, "simhash-index")
    queries = index.where("asked > 0")
    pairs = within_radius(index.select("fp"), queries.select("fp"))
    near = pairs.join(queries.withColumnRenamed("fp", "query_fp"), "query_fp").groupBy("fp").agg(F.sum("asked").alias("near"))
    near = written(near, "simhash-near")
    got = own.join(broadcast_if_small(near, near.count()), "fp", "left")
    return got.select(
        "doc_id", "n_chars", "edited_sha256", as_hex(F.col("fp")).alias("fingerprint"),
        as_hex(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        (F.coalesce("near", F.lit(0)) - asked.cast("bigint")).cast("bigint").alias("near_queries"))
