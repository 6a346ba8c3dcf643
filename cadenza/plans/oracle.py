"""DuckDB SQL for the oracle check: the same answers, written as plain relational SQL.

The oracle is independent of the Spark code paths: labels come from unnest + join + window
instead of array aggregation, vectors are sparse rows instead of dense arrays, and similarity
is a sparse dot product over all pairs instead of matrix blocks.
"""

from __future__ import annotations

import string

from cadenza.functions.text import PUNCTUATION
from cadenza.operators.label import EMOTIONS, LABELS_PER_TEXT, LEXICON_MIN_LEN, LEXICON_SIZE, SEED_WORDS


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


PUNCT_SQL = q(PUNCTUATION)
assert PUNCTUATION == string.punctuation


def emotions_cte() -> str:
    rows = ", ".join(f"({i}, {q(e)})" for i, e in enumerate(EMOTIONS))
    return f"emo AS (SELECT * FROM (VALUES {rows}) t(emotion_id, emotion))"


def hex_int(expr: str, start: int, length: int) -> str:
    return f"CAST(('0x' || substr(md5({expr}), {start}, {length}))::UBIGINT AS BIGINT)"


def lexicon_cte(corpus: str = "documents", size: int = LEXICON_SIZE, min_len: int = LEXICON_MIN_LEN) -> str:
    n = len(EMOTIONS)
    return f"""lex AS (
  SELECT word, CAST({hex_int('word', 1, 8)} % {n} AS INTEGER) AS emotion_id
  FROM (SELECT word, count(*) AS freq
        FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM {corpus})
        WHERE length(word) >= {min_len} AND word NOT IN ({', '.join(map(q, SEED_WORDS))})
        GROUP BY word ORDER BY freq DESC, word LIMIT {size})
  UNION ALL SELECT * FROM (VALUES {', '.join(f"({q(w)}, {EMOTIONS.index(e)})" for w, e in SEED_WORDS.items())}) s(w, e)
), {emotions_cte()}"""


def songs_cte(name: str = "songs", src: str = "documents") -> str:
    return (f"{name} AS (SELECT source AS artist, 'doc-' || CAST(doc_id AS VARCHAR) AS song, "
            f"'/doc/' || CAST(doc_id AS VARCHAR) AS link, text FROM {src})")


def sentences_cte(name: str = "sentences") -> str:
    return (f"{name} AS (SELECT CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS query_id, text AS user_input "
            f"FROM conversations WHERE role = 'user')")


def label_ctes(name: str, src: str, key: str, text: str, out: str, verdict: str | None = None) -> str:
    """``name``: all columns of ``src`` plus ``out``: ten emotions joined by ', ', or ERROR
    (``verdict``: another expression over ``t.n`` and ``t.names``)."""
    verdict = verdict or ("CASE WHEN coalesce(t.n, 0) BETWEEN 10 AND 11 THEN t.names "
                          "ELSE 'ERROR: ' || coalesce(t.names, '') END")
    return f"""{name}_tok AS (
  SELECT {key}, unnest(regexp_extract_all(lower({text}), '[a-z]+')) AS word FROM {src}
), {name}_cnt AS (
  SELECT t.{key}, e.emotion, count(*) AS c
  FROM {name}_tok t JOIN lex USING (word) JOIN emo e USING (emotion_id) GROUP BY ALL
), {name}_top AS (
  SELECT {key}, string_agg(emotion, ', ' ORDER BY c DESC, emotion) AS names, count(*) AS n
  FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY c DESC, emotion) AS rk FROM {name}_cnt)
  WHERE rk <= {LABELS_PER_TEXT} GROUP BY {key}
), {name} AS (
  SELECT s.*, {verdict} AS {out}
  FROM {src} s LEFT JOIN {name}_top t USING ({key})
)"""


def sparse_ctes(name: str, src: str, key: str, text: str, dim: int) -> str:
    """``name``: (key, bucket, weight) of the hashed vector; ``name_norm``: (key, norm)."""
    return f"""{name} AS (
  SELECT {key}, bucket, CAST(sum(sgn) AS DOUBLE) AS weight
  FROM (SELECT {key}, {hex_int('w', 1, 8)} % {dim} AS bucket,
               CASE WHEN {hex_int('w', 9, 1)} % 2 = 0 THEN 1 ELSE -1 END AS sgn
        FROM (SELECT {key}, unnest(regexp_extract_all(lower({text}), '[a-z]+')) AS w FROM {src}))
  GROUP BY ALL HAVING sum(sgn) <> 0
), {name}_norm AS (
  SELECT {key}, sqrt(sum(weight * weight)) AS norm FROM {name} GROUP BY {key}
)"""


def song_index_ctes(dim: int, songs_src: str = "documents", with_errors: bool = False) -> str:
    """songs, labeled (songs + llm_labeled_emotions), idx (labeled rows fit for the index),
    dsp / dsp_norm (their sparse vectors)."""
    fit = "TRUE" if with_errors else "NOT contains(llm_labeled_emotions, 'ERROR')"
    return ",\n".join([
        lexicon_cte(),
        songs_cte("songs", songs_src),
        label_ctes("labeled", "songs", "link", "text", "llm_labeled_emotions"),
        f"idx_src AS (SELECT * FROM labeled WHERE {fit})",
        sparse_ctes("dsp", "idx_src", "link", "llm_labeled_emotions", dim),
        "idx AS (SELECT i.*, n.norm FROM idx_src i JOIN dsp_norm n USING (link))",
    ])


def topk_sql(qsp: str, dsp: str, qkey: str, dkey: str, k: int, digits: int = 6,
             exclude_self: bool = False) -> str:
    """CTE body text: ``ranked(qkey, dkey, score, rank)`` over all (query, item) pairs."""
    self_filter = f"WHERE p.{qkey} <> p.{dkey}" if exclude_self else ""
    return f"""pairs AS (
  SELECT a.{qkey}, b.{dkey}, a.norm AS qn, b.norm AS dn FROM {qsp}_norm a CROSS JOIN {dsp}_norm b
), dots AS (
  SELECT a.{qkey}, b.{dkey}, sum(a.weight * b.weight) AS dot
  FROM {qsp} a JOIN {dsp} b USING (bucket) GROUP BY ALL
), scored AS (
  SELECT p.{qkey}, p.{dkey}, round(coalesce(d.dot, 0) / (p.qn * p.dn), {digits}) AS score
  FROM pairs p LEFT JOIN dots d ON d.{qkey} = p.{qkey} AND d.{dkey} = p.{dkey} {self_filter}
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY {qkey} ORDER BY score DESC, {dkey}) AS INTEGER) AS rank
  FROM scored
)"""


def recommend_sql(dim: int, k: int = 10, embed_source: str = "labels") -> str:
    qtext = "user_emotions" if embed_source == "labels" else "clean_input"
    ctes = ",\n".join([
        song_index_ctes(dim),
        sentences_cte(),
        f"qclean AS (SELECT query_id, translate(user_input, {PUNCT_SQL}, '') AS clean_input FROM sentences)",
        label_ctes("qlab", "qclean", "query_id", "clean_input", "user_emotions", "t.names"),
        sparse_ctes("qsp", "qlab", "query_id", qtext, dim),
        topk_sql("qsp", "dsp", "query_id", "link", k),
    ])
    return f"""WITH {ctes}
SELECT r.query_id, ql.user_emotions, r.rank, i.artist, i.song, r.link, i.llm_labeled_emotions, r.score
FROM ranked r JOIN qlab ql USING (query_id) JOIN idx i USING (link)
WHERE r.rank <= {k}"""
