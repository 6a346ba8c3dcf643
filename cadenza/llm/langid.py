"""Language ID (operator 4): script ranges, per-word scores, and Viterbi with a switch penalty.

The model is learned by Spark from labelled rows: for every language the counts of hashed
byte trigrams of words (with their edges) and of whole words, and the scripts its words are
written in. A word's score for a language is the sum of its features' log probabilities,
against the mean of the languages; only languages that use the word's script are candidates.
Viterbi then finds the sequence of languages of a text's words that scores best when every
switch costs ``penalty``; runs of a language are the spans of a mixed text.

Viterbi runs on whole batches of texts at once: words are cut into blocks, the best way
through each block from every language to every other is found for all blocks together, the
blocks of a text are chained, and the best language of each word follows from the best path
to it and from it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import _LOWER, bounded_batches, mix64, word_chunks

#: Labelled rows of each language that train the model at most (drawn by hash of the id).
TRAIN_ROWS = 5_000
BUCKETS = 1 << 16
PENALTY = 12.0
BLOCK = 32
#: A language uses a script in which at least this share of its words is written.
SCRIPT_SHARE = 0.01
#: Learned languages at most; a lang column with more values is not a list of languages.
MAX_LANGS = 1_000

# Letter ranges of scripts (Unicode blocks), first and last code point
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)], "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)], "hebrew": [(0x590, 0x5FF)], "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)], "bengali": [(0x980, 0x9FF)], "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)], "georgian": [(0x10A0, 0x10FF)], "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)], "hangul": [(0xAC00, 0xD7AF)],
}


def _script_tables() -> tuple[np.ndarray, np.ndarray]:
    """Script of an ASCII byte, and of a lead byte with its first continuation byte."""
    one, two = np.zeros(256, np.int64), np.zeros(1 << 16, np.int64)
    for no, ranges in enumerate(SCRIPTS.values(), 1):
        for lo, hi in ranges:
            for cp in range(lo, hi + 1, 1 if lo < 0x800 else 64):
                raw = chr(cp).encode()
                if len(raw) == 1:
                    one[raw[0]] = no
                else:
                    two[raw[0] << 8 | raw[1]] = no
    return one, two


_ONE, _TWO = _script_tables()


def _word_features(words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, word) of every feature of a chunk's words, and each word's script (0: none)."""
    data = _LOWER[words.data]
    lens = words.end - words.start
    if not len(lens):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = np.repeat(np.arange(len(lens)), lens)
    at = np.arange(len(word)) - np.repeat(np.cumsum(lens) - lens, lens)
    pos = at + words.start[word]
    here = data[pos].astype(np.uint64)
    before = np.where(at > 0, data[np.maximum(pos - 1, 0)], 32).astype(np.uint64)
    after = np.where(at + 1 < lens[word], data[np.minimum(pos + 1, len(data) - 1)], 32).astype(np.uint64)
    tri = mix64(before << np.uint64(16) | here << np.uint64(8) | after)
    pair = (here << np.uint64(8) | after).astype(np.int64)
    script = np.maximum.reduceat(np.where(here < 128, _ONE[here.astype(np.int64)], _TWO[pair]),
                                 np.cumsum(lens) - lens)
    whole = mix64(words.hashes(lower=True) + np.uint64(1))
    bucket = np.concatenate((tri, whole)) % np.uint64(BUCKETS)
    return bucket.astype(np.int64), np.concatenate((word, np.arange(len(lens)))), script


def _count(batches):
    """(lang, kind, bucket, n): feature counts (kind 0) and words by script (kind 1)."""
    import pyarrow as pa

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        names = sorted(set(langs))
        code = np.array([names.index(x) for x in langs], np.int64)
        feats = np.zeros((len(names), BUCKETS), np.int64)
        scripts = np.zeros((len(names), len(SCRIPTS) + 1), np.int64)
        for words in word_chunks(batch.column("text")):
            bucket, word, script = _word_features(words)
            lang = code[words.lo:words.hi][words.row]
            ok = script[word] > 0
            feats += np.bincount(lang[word[ok]] * BUCKETS + bucket[ok], minlength=feats.size).reshape(feats.shape)
            scripts += np.bincount(lang * scripts.shape[1] + script, minlength=scripts.size).reshape(scripts.shape)
        for kind, table in enumerate((feats, scripts)):
            i, j = np.nonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[x] for x in i], pa.string()), pa.array(np.full(len(i), kind, np.int32)),
                 pa.array(j), pa.array(table[i, j])], names=["lang", "kind", "bucket", "n"])


class LanguageModel:
    """Learned languages, their feature scores [bucket, language] and scripts [script, language]."""

    def __init__(self, langs: list[str], scores: np.ndarray, scripts: np.ndarray):
        self.langs, self.scores, self.scripts = langs, scores, scripts

    @staticmethod
    def fit(labelled: DataFrame, rows: int = TRAIN_ROWS) -> "LanguageModel":
        """From ``(doc_id, text, lang)``, of which rows with null lang or text are left out.

        Per language at most about ``rows`` rows train, drawn by a hash of their id; the counts
        are summed by Spark, so the driver gets at most ``BUCKETS`` numbers a language.
        """
        bounded_batches(labelled.sparkSession)
        use = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
        sizes = use.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGS + 1).collect()
        if len(sizes) > MAX_LANGS:
            raise ValueError(f"lang has over {MAX_LANGS} values")
        if not sizes:
            return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS) + 1, 0), bool))
        langs = sorted(r["lang"] for r in sizes)
        keep = F.lit(False)
        draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)).cast("double") / F.lit(float(1 << 30))
        for r in sizes:
            keep = keep | ((F.col("lang") == F.lit(r["lang"])) & (draw < F.lit(min(1.0, rows / r["n"]))))
        counts = (use.where(keep).select("text", "lang")
                  .mapInArrow(_count, "lang string, kind int, bucket bigint, n bigint")
                  .groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n")).toPandas())
        code = counts["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()
        feats, scripts = np.zeros((BUCKETS, len(langs))), np.zeros((len(SCRIPTS) + 1, len(langs)))
        for kind, table in enumerate((feats, scripts)):
            own = (counts["kind"] == kind).to_numpy()
            table[counts["bucket"].to_numpy()[own], code[own]] = counts["n"].to_numpy()[own]
        log = np.log((feats + 0.3) / (feats.sum(0) + 0.3 * BUCKETS))
        scripts[0] = 0
        return LanguageModel(langs, (log - log.mean(1, keepdims=True)).astype(np.float32),
                             scripts >= np.maximum(SCRIPT_SHARE * scripts.sum(0), 1))

    def word_scores(self, words) -> tuple[np.ndarray, np.ndarray]:
        """Scores [word, language], and which words have letters of a known script."""
        bucket, word, script = _word_features(words)
        n, size = len(words.start), len(self.langs)
        out = np.empty((n, size))
        for j in range(size):
            out[:, j] = np.bincount(word, self.scores[:, j][bucket], minlength=n)
        allowed = self.scripts[script]
        out = np.where(allowed, out, -1e3)
        out[~allowed.any(1)] = 0            # a script nobody learned says nothing
        out[script == 0] = 0
        return out, script > 0


def _advance(v: np.ndarray, penalty: float) -> np.ndarray:
    """Best score of being in each language after an optional switch."""
    return np.maximum(v, v.max(-1, keepdims=True) - penalty)


def best_languages(scores: np.ndarray, counts: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The language of every word on its text's best path; ``counts``: words of each text."""
    n, size = scores.shape
    if n == 0:
        return np.zeros(0, np.int64)
    blocks = -(-counts // BLOCK)
    first = np.concatenate(([0], np.cumsum(blocks)))
    in_text = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    slot = (np.repeat(first[:-1], counts) + in_text // BLOCK) * BLOCK + in_text % BLOCK
    grid = np.zeros((first[-1] * BLOCK, size))
    grid[slot] = scores
    grid = grid.reshape(-1, BLOCK, size)
    through = np.where(np.eye(size, dtype=bool), 0.0, -1e18)[None].repeat(len(grid), 0)
    for t in range(BLOCK):
        through = _advance(through, penalty) + grid[:, None, t]
    # chain the blocks of each text: alpha before, beta after every block
    alpha, beta = np.zeros((len(grid), size)), np.zeros((len(grid), size))
    for step in range(1, int(blocks.max())):
        at = first[:-1][blocks > step] + step
        alpha[at] = (alpha[at - 1][:, :, None] + through[at - 1]).max(1)
        back = first[1:][blocks > step] - 1 - step
        beta[back] = (through[back + 1] + beta[back + 1][:, None]).max(2)
    score = np.empty_like(grid)
    v = alpha
    for t in range(BLOCK):
        v = _advance(v, penalty) + grid[:, t]
        score[:, t] = v
    v = beta
    for t in range(BLOCK - 1, -1, -1):
        score[:, t] += v
        v = _advance(v + grid[:, t], penalty)
    return score.reshape(-1, size)[slot].argmax(1)


def _label(batches, model: LanguageModel, penalty: float):
    import pyarrow as pa

    langs = np.array([*model.langs, "und"], object)
    size = len(model.langs)
    for batch in batches:
        for words in word_chunks(batch.column("text")):
            scores, letters = model.word_scores(words)
            scores, count = scores[letters], np.bincount(words.row[letters], minlength=words.rows)
            row = words.row[letters]
            best = best_languages(scores, count, penalty) if size else np.zeros(len(row), np.int64)
            own = np.zeros((words.rows, max(size, 1)))
            np.add.at(own, (row, best), 1.0)
            top = own.argmax(1)
            mine = best == top[row]
            total = np.zeros((words.rows, max(size, 1)))
            if size:
                np.add.at(total, row[mine], scores[mine])
            total = np.exp(total - total.max(1, keepdims=True))
            sure = total[np.arange(words.rows), top] / total.sum(1)
            known = (count > 0) & (size > 0)
            score = np.where(known, own[np.arange(words.rows), top] / np.maximum(count, 1) * sure, 0.0)
            # spans: runs of a language among the words with letters, as word numbers
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (best[1:] != best[:-1])
            new &= size > 0
            at = np.flatnonzero(new)
            number = np.flatnonzero(letters) - words.first[row]
            last = np.append(at[1:] - 1, len(row) - 1)[:len(at)]
            spans = pa.StructArray.from_arrays(
                [pa.array(number[at], pa.int64()), pa.array(number[last] + 1, pa.int64()),
                 pa.array(langs[best[at]], pa.string())], names=["start", "end", "lang"])
            off = np.concatenate(([0], np.cumsum(np.bincount(row[at], minlength=words.rows)))).astype(np.int32)
            part = batch.slice(words.lo, words.rows)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(langs[np.where(known, top, size)], pa.string()), pa.array(score),
                 pa.ListArray.from_arrays(pa.array(off), spans)],
                names=[*part.schema.names, "_cz_lang", "_cz_score", "_cz_spans"])


def label_languages(docs: DataFrame, model: LanguageModel, penalty: float = PENALTY) -> DataFrame:
    """``docs`` plus ``lang_pred``, ``score`` (0 to 1) and ``spans`` (runs of a language, by word
    number, end exclusive); columns of these names are replaced.

    ``lang_pred`` has most of the words; ``und`` with score 0 for null text, text without
    letters, or if nothing was learned. A text with letters of unknown scripts only gets the
    first learned language with the score of a guess.
    """
    from pyspark.sql.types import StructType

    bounded_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score", "spans")
    schema = StructType.fromDDL("_cz_lang string, _cz_score double, "
                                "_cz_spans array<struct<start: bigint, end: bigint, lang: string>>")
    got = docs.mapInArrow(lambda it: _label(it, model, penalty), StructType([*docs.schema.fields, *schema.fields]))
    # letters of scripts outside the table above still make a text one with letters
    other = (F.col("_cz_lang") == "und") & F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)) & F.lit(bool(model.langs))
    return got.select(
        *docs.columns, F.when(other, F.lit(model.langs[0] if model.langs else "und")).otherwise(F.col("_cz_lang"))
        .alias("lang_pred"),
        F.when(other, F.lit(1.0 / max(len(model.langs), 1))).otherwise(F.col("_cz_score")).alias("score"),
        F.col("_cz_spans").alias("spans"))


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id's text is 2 modulo 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def language_table(docs: DataFrame) -> DataFrame:
    """Predicted language of every document, learned from the rows that are not held out.

    Rows with a null id neither train nor are held out.
    """
    train = docs.where(F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "text", "lang")
    got = label_languages(docs.select("doc_id", "text"), LanguageModel.fit(train))
    return got.select("doc_id", held_out().alias("held_out"), "lang_pred", "score",
                      F.size("spans").cast("bigint").alias("n_spans"))
