"""Prompt trial (J1, P6, F13, M3, A5): every song under every prompt, then a side-by-side view.

The prompt list is a small fixed literal, so "every song by every prompt" is a generator
(``inline`` of a literal array) on each song row: no join, no shuffle. The filled-in word of
``"{prompt} {text}"`` is the top emotion of the text's counts plus the prompt's counts: the
text is counted once per song, not once per prompt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import MASK_PROMPTS, join_prompt
from cadenza.operators.label import EMOTIONS, emotion_counts, top_emotions
from cadenza.session import local_frame


def prompt_counts(lexicon: DataFrame, prompts: Sequence[tuple[str, str]]) -> dict[str, list[int]]:
    """Emotion counts of each prompt's own words (a handful of rows, computed once)."""
    spark = lexicon.sparkSession
    frame = local_frame(spark, prompts, "prompt_label string, prompt string")
    rows = frame.select("prompt_label", emotion_counts("prompt", lexicon).alias("counts")).collect()
    return {r["prompt_label"]: list(r["counts"]) for r in rows}


def prompt_grid(songs: DataFrame, lexicon: DataFrame, prompts: Sequence[tuple[str, str]] = MASK_PROMPTS,
                text: str = "text") -> DataFrame:
    """``songs columns but text, prompt_label, prompt, input, result``: one row per song row and
    prompt; ``input`` is ``"{prompt} {text}"`` and ``result`` its most frequent emotion."""
    fixed = prompt_counts(lexicon, prompts)
    literal = F.array(*[
        F.struct(F.lit(label).alias("prompt_label"), F.lit(p).alias("prompt"),
                 F.array(*[F.lit(c).cast("bigint") for c in fixed[label]]).alias("pcounts"))
        for label, p in prompts])
    grid = songs.select("*", emotion_counts(text, lexicon).alias("_counts")).select("*", F.inline(literal))
    grid = grid.select("*", F.zip_with("_counts", "pcounts", lambda a, b: a + b).alias("_total"))
    best = F.try_element_at(top_emotions("_total", EMOTIONS, 1), F.lit(1))
    order = [c for c in songs.columns if c != text]
    return grid.select(*order, "prompt_label", "prompt", join_prompt("prompt", text).alias("input"),
                       best.alias("result"))


def prompt_compare(grid: DataFrame, group: Sequence[str] = ("link", "song"),
                   prompts: Sequence[tuple[str, str]] = MASK_PROMPTS) -> DataFrame:
    """One row per song (by its link, with its title), one column of results per prompt (A5);
    the pivot values are given, so no extra pass looks for them."""
    labels = [label for label, _ in prompts]
    return grid.groupBy(*group).pivot("prompt_label", labels).agg(F.first("result"))


def prompt_agreement(grid: DataFrame, unit: str = "link", value: str = "result") -> DataFrame:
    """Krippendorff's alpha of the prompts' results (A5): agreement corrected for chance, 1 if all
    prompts answer alike, about 0 if as by chance; null if all answers are one value or none.

    Null results are missing answers; a unit counts with two answers or more. Only counts per (unit,
    value) are shuffled, and the rest are sums of integers, so the result is exact up to its rounding.
    """
    cells = grid.where(F.col(value).isNotNull()).groupBy(unit, value).agg(F.count(F.lit(1)).alias("n"))
    units = cells.groupBy(unit).agg(F.sum("n").alias("m"), F.sum(F.col("n") * (F.col("n") - 1)).alias("same"),
                                    F.collect_list(F.struct(F.col(value).alias("v"), "n")).alias("values"))
    paired = units.where("m >= 2")
    alike = paired.groupBy("m").agg(F.count(F.lit(1)).alias("units"), F.sum("same").alias("same"))
    observed = alike.select("units", (F.col("m") * F.col("units")).alias("n"), (F.col("same") / (F.col("m") - 1)).alias("o"),
                            F.lit(0).cast("bigint").alias("e"))
    totals = paired.select(F.inline("values")).groupBy("v").agg(F.sum("n").alias("n"))
    chance = totals.select(F.lit(0).cast("bigint").alias("units"), F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("o"),
                           (F.col("n") * (F.col("n") - 1)).alias("e"))
    sums = observed.unionByName(chance).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("units", "n", "o", "e")])
    n = F.col("n")
    apart, expected = 1 - F.try_divide("o", n), 1 - F.try_divide("e", n * (n - 1))
    return sums.select(F.col("units").alias("n_units"), n.alias("n_values"), F.round(apart, 9).alias("disagreement"),
                       F.round(expected, 9).alias("expected"), F.round(1 - F.try_divide(apart, expected), 9).alias("alpha"))
