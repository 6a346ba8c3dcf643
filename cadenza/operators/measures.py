"""Sampling and label measures (L4, A1-A3, P5, F17) and the stated next steps (M9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.text import is_error_label, label_items
from cadenza.functions.vectors import md5_hex_int, tokens

SAMPLE_RANGE = 1 << 32

# ---------------------------------------------------------------------------
# Fixed values (ours): words that mark a holiday song.
HOLIDAY_WORDS = ("christmas", "xmas", "santa", "holiday", "holidays", "noel", "sleigh",
                 "reindeer", "mistletoe", "jingle", "yuletide", "carol", "carols", "snowman")
# ---------------------------------------------------------------------------


def sample_by_key(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Bernoulli-like sample decided by a 32-bit hash of the key (L4): the same rows on every run,
    every retry and every partitioning, unlike an unseeded ``sample``. A filter: no shuffle."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    return df.where(md5_hex_int(F.col(key), 1, 8) < int(round(fraction * SAMPLE_RANGE)))


SAMPLE_BUCKETS = 1 << 16         # of the hashes that an exact-size sample counts


def sample_exact(df: DataFrame, key: str, n: int, stratum: str | None = None) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), overall or of every value of ``stratum`` (null is
    one): those whose keys hash lowest, ties by key, so reruns agree (L4).

    No global sort: one pass counts rows per 16 leading bits of the hash, which tells the bucket
    that the n-th row lies in; rows of lower buckets are taken by a filter, and only those of that
    bucket (one in 65,536) are ranked. Null keys come last. Repeated keys are ranked by all their
    values; equal rows stand for one another.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    group = F.col(stratum) if stratum else F.lit(0)
    keyed = df.select("*", F.struct(group.alias("g")).alias("_g"),      # a struct: null strata meet
                      F.coalesce(md5_hex_int(F.col(key).cast("string"), 1, 4), F.lit(SAMPLE_BUCKETS)).alias("_b"))
    counts = keyed.groupBy("_g", "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("_g").orderBy("_b")
    edge = (counts.withColumn("_sum", F.sum("_n").over(w)).where((F.col("_sum") >= n) & (F.col("_sum") - F.col("_n") < n))
            .select("_g", F.col("_b").alias("_edge"), (n - F.col("_sum") + F.col("_n")).alias("_need")))
    if n == 0:
        return df.limit(0)
    met = keyed.join(edge, "_g", "left")
    below = met.where(F.col("_edge").isNull() | (F.col("_b") < F.col("_edge")))
    order = [md5_hex_int(F.col(key).cast("string"), 1, 15), F.col(key), F.xxhash64(*df.columns)]
    last = (met.where(F.col("_b") == F.col("_edge"))
            .withColumn("_rn", F.row_number().over(Window.partitionBy("_g").orderBy(*order))).where("_rn <= _need"))
    return below.select(*df.columns).unionByName(last.select(*df.columns))


def error_rows(labeled: DataFrame, label: str = "llm_labeled_emotions") -> DataFrame:
    """Rows whose label holds ERROR (P5)."""
    return labeled.where(is_error_label(label))


def error_rate(labeled: DataFrame, label: str = "llm_labeled_emotions") -> DataFrame:
    """Rows, error rows, and ``round(errors / rows, 2) * 100`` (A2, A3); the denominator is
    the real row count, null labels included."""
    n = F.count(F.lit(1))
    errors = F.count_if(is_error_label(label))
    return labeled.agg(n.alias("n_songs"), errors.alias("n_errors"),
                       (F.round(F.try_divide(errors, n), 2) * 100).alias("error_pct"))


def label_form(labeled: DataFrame, key: str = "link", label: str = "llm_labeled_emotions",
               expected: int = 10) -> DataFrame:
    """Per row: label items, distinct items, and whether it is ten distinct words."""
    items = label_items(label)
    n = F.size(items)
    distinct = F.size(F.array_distinct(items))
    ok = ~F.coalesce(is_error_label(label), F.lit(True)) & (n == expected) & (distinct == expected)
    return labeled.select(key, n.alias("n_items"), distinct.alias("n_distinct"), ok.alias("well_formed"))


def exclude_flagged(songs: DataFrame, flags: DataFrame, key: str = "link") -> DataFrame:
    """Songs not flagged (M9): a left anti join on the key."""
    return songs.join(flags.select(key), key, "left_anti")


def holiday_tag(songs: DataFrame, text: str = "text", words: Sequence[str] = HOLIDAY_WORDS,
                out: str = "is_holiday") -> DataFrame:
    """Mark songs whose text holds a holiday word as a whole token (M9); map-only."""
    marked = F.coalesce(F.arrays_overlap(tokens(F.col(text)), F.array(*[F.lit(w) for w in words])),
                        F.lit(False))
    return songs.withColumn(out, marked)
