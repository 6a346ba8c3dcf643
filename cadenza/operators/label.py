"""Emotion labeling (M1-M3), row by row.

Each row's tokens are looked up in a small lexicon of emotion words inside an Arrow kernel
(one hash lookup per token, vectorised), which counts the hits per emotion. The ten most
frequent emotions (ties by name) form the model answer ``[e1, e2, ...]``, which then goes
through a cleaner, as an answer of a language model would (for cleaner v2 the cleaner's rule is
applied directly: on answers of this form it is exactly the same, which a test checks). Nothing
is shuffled and rows need no key: rows with equal or null keys keep their own labels.

The lexicon is built from the corpus itself: the most frequent words of a minimum length,
each mapped to an emotion by a hash of the word, plus a few fixed mood words. Its size has a
hard cap, which is checked before it is shipped to the tasks.

A plug-in labeler (e.g. a pandas UDF that calls a model) is any ``DataFrame -> DataFrame``
function that adds the label column; :func:`udf_labeler` wraps a Column-level model.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import CLEANERS, V2_ECHO_MARK, V2_ERROR_PREFIX, V2_MAX_WORDS, V2_MIN_WORDS
from cadenza.functions.vectors import md5_hex_int, sql_name, tokens
from cadenza.llm.common import bounded_batches
from cadenza.session import local_frame

# ---------------------------------------------------------------------------
# Fixed values (ours): the eight basic emotions of Plutchik's published wheel and then their
# intense forms; emotion number n (0-based) is the n-th name.
EMOTIONS = (
    "joy", "trust", "fear", "surprise", "sadness", "disgust", "anger", "anticipation",
    "ecstasy", "admiration", "terror", "amazement", "grief", "loathing", "rage", "vigilance",
)
# Words that every lexicon holds (corpus words of the same spelling give way to them): the names on
# Plutchik's wheel that are long enough for it. An emotion of ours stands for itself, a mild form for the basic emotion of its
# petal, a primary dyad for the first of the two basic emotions it blends.
MILD_FORMS = {
    "serenity": "joy", "acceptance": "trust", "apprehension": "fear", "distraction": "surprise",
    "pensiveness": "sadness", "boredom": "disgust", "annoyance": "anger", "interest": "anticipation",
}
DYADS = {
    "love": "joy", "submission": "trust", "awe": "fear", "disapproval": "surprise",
    "remorse": "sadness", "contempt": "disgust", "aggressiveness": "anger", "optimism": "anticipation",
}
LEXICON_SIZE = 200      # words in the lexicon
LEXICON_MIN_LEN = 4     # shortest word taken
SEED_WORDS = {w: e for w, e in ({e: e for e in EMOTIONS} | MILD_FORMS | DYADS).items() if len(w) >= LEXICON_MIN_LEN}
LABELS_PER_TEXT = 10    # emotions asked for
LEXICON_MAX_SIZE = 100_000  # broadcast bound
# ---------------------------------------------------------------------------

# The default labeler's answer is "[n1, n2, ...]" over the names above. Every name is one
# lower-case word without the echo mark, so cleaner v2 on that answer keeps the names as they
# are and only checks their number; label_emotions uses that shortcut (same result, no regex).
assert all(re.fullmatch("[a-z]+", e) and V2_ECHO_MARK not in e for e in EMOTIONS)


def build_lexicon(corpus: DataFrame, text: str = "text", size: int = LEXICON_SIZE,
                  min_len: int = LEXICON_MIN_LEN, emotions: Sequence[str] = EMOTIONS,
                  seeds: bool = True) -> DataFrame:
    """Lexicon ``(word, freq, emotion_id, emotion)`` of the ``size`` most frequent tokens, and
    of the fixed mood words (``freq`` 0) unless ``seeds`` is off.

    Ties go by word. One partial aggregation (map-side combine) per distinct word, then a
    bounded top-``size`` (TakeOrderedAndProject).
    """
    if not 0 < size <= LEXICON_MAX_SIZE:
        raise ValueError(f"lexicon size must be in 1..{LEXICON_MAX_SIZE}")
    n = len(emotions)
    # Runs of at least min_len letters, matched directly: a greedy leftmost match cannot start
    # inside a run, so these are exactly the long tokens, and the short ones are never exploded.
    long_tokens = tokens(F.col(text), pattern=f"[a-z]{{{min_len},}}")
    words = corpus.select(F.explode(long_tokens).alias("word")).where(F.length("word") >= min_len)
    words = words.where(~F.col("word").isin(*SEED_WORDS)) if seeds else words
    top = (words.groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
           .orderBy(F.desc("freq"), F.asc("word")).limit(size))
    emotion_id = (md5_hex_int(F.col("word"), 1, 8) % n).cast("int")
    names = F.array(*[F.lit(e) for e in emotions])
    out = top.select("word", "freq", emotion_id.alias("emotion_id"),
                     F.element_at(names, emotion_id + 1).alias("emotion"))
    if seeds:
        fixed = [(w, 0, emotions.index(e), e) for w, e in SEED_WORDS.items() if e in emotions]
        out = out.unionByName(local_frame(corpus.sparkSession, fixed, out.schema))
    return out


def materialize_lexicon(lexicon: DataFrame) -> DataFrame:
    """Compute the lexicon once and keep it as a local relation in the plan.

    Its size is bounded by construction (``size`` <= LEXICON_MAX_SIZE rows), so holding it on
    the driver is safe; every later plan broadcasts it without recomputing the corpus pass,
    and a lost executor never needs the corpus again to rebuild it.
    """
    rows = lexicon.limit(LEXICON_MAX_SIZE + 1).collect()
    if len(rows) > LEXICON_MAX_SIZE:
        raise ValueError("lexicon exceeds its broadcast bound")
    return local_frame(lexicon.sparkSession, rows, lexicon.schema)


def emotion_counts(text: str, lexicon: DataFrame, n_emotions: int = len(EMOTIONS)) -> Column:
    """Hits per emotion in a text: array<bigint>, one entry per emotion (0 for null text)."""
    rows = lexicon.select("word", "emotion_id").limit(LEXICON_MAX_SIZE + 1).collect()
    if len(rows) > LEXICON_MAX_SIZE:
        raise ValueError("lexicon exceeds its bound")
    bounded_batches(lexicon.sparkSession)        # the tokens of whole texts go to Python
    words, ids = pa.array([r[0] for r in rows], pa.string()), np.array([r[1] for r in rows], np.int64)

    def count(tokens: pa.Array) -> pa.Array:
        at = pc.index_in(tokens.flatten(), value_set=words)
        hit = at.is_valid().to_numpy(zero_copy_only=False)
        row = pc.list_parent_indices(tokens).to_numpy(zero_copy_only=False)[hit]
        cells = row * n_emotions + ids[at.drop_null().to_numpy(zero_copy_only=False)]
        counts = np.bincount(cells, minlength=len(tokens) * n_emotions).astype(np.int64)
        offsets = np.arange(0, len(counts) + 1, n_emotions, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts))

    return F.arrow_udf(count, "array<bigint>")(tokens(F.col(text)))


def top_emotions_sql(counts: str, emotions: Sequence[str] = EMOTIONS, top_n: int = LABELS_PER_TEXT) -> str:
    """SQL for the names of the ``top_n`` emotions with a count in ``counts`` (an SQL
    expression of array<bigint>), by count then name."""
    items = ", ".join(f"named_struct('neg', -{counts}[{i}], 'emotion', '{e}')" for i, e in enumerate(emotions))
    return f"transform(slice(array_sort(filter(array({items}), p -> p.neg < 0)), 1, {top_n}), p -> p.emotion)"


def top_emotions(counts: str, emotions: Sequence[str] = EMOTIONS, top_n: int = LABELS_PER_TEXT) -> Column:
    """Names of the ``top_n`` emotions with a count in column ``counts``, by count then name."""
    return F.expr(top_emotions_sql(sql_name(counts), emotions, top_n))


def answer_text(names: Column) -> Column:
    """The labeler's raw answer, shaped as a model's Python array: ``[a, b, c]``."""
    return F.concat(F.lit("["), F.array_join(names, ", "), F.lit("]"))


def label_emotions(df: DataFrame, lexicon: DataFrame, text: str = "text",
                   out: str = "llm_labeled_emotions", cleaner: str | None = "v2",
                   emotions: Sequence[str] = EMOTIONS, top_n: int = LABELS_PER_TEXT) -> DataFrame:
    """``df`` with its label in column ``out`` (M1/M2, P1), row by row and map-only."""
    counted = df.withColumn("_counts", emotion_counts(text, lexicon, len(emotions)))
    names = top_emotions_sql("_counts", emotions, top_n)
    if cleaner == "v2" and emotions is EMOTIONS:
        # names evaluated once (a one-element transform), then cleaner v2's verdict
        label = F.expr(
            f"element_at(transform(array({names}), n -> IF(size(n) BETWEEN {V2_MIN_WORDS} AND {V2_MAX_WORDS}, "
            f"array_join(n, ', '), concat('{V2_ERROR_PREFIX}', array_join(n, ', ')))), 1)")
    else:
        label = CLEANERS[cleaner](answer_text(F.expr(names)))
    return counted.withColumn(out, label).drop("_counts")


def mood(df: DataFrame, lexicon: DataFrame, text: str = "text", out: str = "user_emotions",
         emotions: Sequence[str] = EMOTIONS, top_n: int = LABELS_PER_TEXT) -> DataFrame:
    """The emotions of a short text, joined by ', '; null if it has none. A sentence is too
    short for the ten emotions that a song's label must have."""
    counted = df.withColumn("_counts", emotion_counts(text, lexicon, len(emotions)))
    names = F.array_join(top_emotions("_counts", emotions, top_n), ", ")
    return counted.withColumn(out, F.nullif(names, F.lit(""))).drop("_counts")


def udf_labeler(model: Callable[[Column], Column], text: str = "text",
                out: str = "llm_labeled_emotions", cleaner: str | None = "v2") -> Callable[[DataFrame], DataFrame]:
    """Wrap a Column-level model (e.g. a pandas UDF marked nondeterministic) as a labeler."""

    def apply(df: DataFrame) -> DataFrame:
        return df.withColumn(out, CLEANERS[cleaner](model(F.col(text))))

    return apply
