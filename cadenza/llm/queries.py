"""The registered queries of the subpackage: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cadenza.llm import (htmltext, jaccard, langid, lines, lloyd, mix, packing, phrases, pii, quality, repeats,
                         simhash, toxicity)
from cadenza.llm.common import documents, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_table(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix_table(documents(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_table(documents(spark, sf_dir))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_table(documents(spark, sf_dir))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(table(spark, sf_dir, "pages"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_table(documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_table(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return lines.line_dedup(docs).select("doc_id", "n_lines", "n_removed", "text")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir), k=4, percent=85)


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.lloyd(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256)


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir), max_words=3, least=10, top=2000, within=50)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_spans(documents(spark, sf_dir), length=200)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_source_mix": op2_source_mix,
    "op3_pii": op3_pii,
    "op4_language_id": op4_language_id,
    "op5_html_extraction": op5_html_extraction,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_packing": op7_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_line_dedup": op9_line_dedup,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_suffix_dedup": op13_suffix_dedup,
}


WORD_SQL = r"[^\x20\x09-\x0D]+"
SPACE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _sql_op9() -> str:
    """Distinct lines that share a half are compared by their edit distance."""
    return f"""WITH parts AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS part, unnest(range(len(string_split(text, chr(10))))) AS no
  FROM documents WHERE text IS NOT NULL),
lines AS (SELECT *, trim(part, {SPACE_SQL}) AS line FROM parts
          WHERE len(regexp_extract_all(part, '{WORD_SQL}')) >= {lines.MIN_WORDS}),
firsts AS (SELECT line, min((doc_id, no)) AS first, length(line) AS n FROM lines GROUP BY line),
halves AS (SELECT line, first, unnest([n, n - 1]) AS base FROM firsts),
anchors AS (SELECT line, first, base, 1 AS side, right(line, base - base // 2) AS anchor FROM halves
            UNION ALL SELECT line, first, base, 0, left(line, base // 2) FROM halves),
gone AS (SELECT DISTINCT a.line FROM anchors a JOIN anchors b USING (base, side, anchor)
         WHERE b.first < a.first AND abs(length(a.line) - length(b.line)) <= 1 AND levenshtein(a.line, b.line) <= 1),
lost AS (SELECT l.doc_id, l.no FROM lines l JOIN firsts f USING (line)
         WHERE f.first <> (l.doc_id, l.no) OR l.line IN (SELECT line FROM gone)),
kept AS (SELECT p.doc_id, count(*) AS n_lines, count(l.no) AS n_removed,
                string_agg(CASE WHEN l.no IS NULL THEN p.part END, chr(10) ORDER BY p.no) AS text
         FROM parts p LEFT JOIN lost l ON l.doc_id = p.doc_id AND l.no = p.no GROUP BY p.doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k USING (doc_id)"""


def _sql_op10(k: int = 4, percent: int = 85) -> str:
    """Common shingles counted for every pair of documents, and reachability over the links."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{WORD_SQL}') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {k - 1}), ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {k - 2}, 2))) AS i FROM w WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
         WHERE 100 * c >= {percent} * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, least(d.doc_id, min(r.b)) AS component_id
FROM documents d LEFT JOIN size s USING (doc_id) LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id"""


def _sql_op11(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256) -> str:
    """Every round as two steps: all distances to the centroids, then the means by cluster."""
    far = f"list_sum(list_transform(range(1, {dims + 1}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT"
    steps = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor(e::DOUBLE * {scale})::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: isfinite(e))) = {dims}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), x) - 1 AS j, x FROM v ORDER BY j LIMIT {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, min((d, j)) AS best
  FROM (SELECT v.r, v.vec_id, c.j, {far} AS d FROM v CROSS JOIN c{i} c) GROUP BY r)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
  SELECT j, list((s - (s % n + n) % n) // n ORDER BY i)::BIGINT[] AS x FROM (
    SELECT a.best[2] AS j, i, sum(v.x[i]) AS s, count(*) AS n FROM a{i} a JOIN v USING (r), range(1, {dims + 1}) t(i) GROUP BY ALL)
  GROUP BY j) m ON m.j = c.j)""")
    return f"""WITH {", ".join(steps)}
SELECT a.vec_id, a.best[2]::INT AS cluster, a.best[1] AS distance, sum(a.best[1]) OVER (PARTITION BY a.best[2])::BIGINT AS cluster_inertia,
       sum(a.best[1]) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.j = a.best[2]"""


def _sql_op12(least: int = 10, top: int = 2000, within: int = 50) -> str:
    """All phrases of one to three words counted by grouping, cuts and containers joined by their words."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (SELECT lang, p, len(p) AS n, count(*) AS f FROM (
    SELECT lang, unnest([list_slice(w, i, i + k - 1) FOR k IN range(1, 4) IF i + k - 1 <= len(w)]) AS p
    FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces)) GROUP BY lang, p),
size AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE n = 1 GROUP BY lang),
cand AS (SELECT lang, p, n, f AS a FROM grams WHERE n >= 2 AND f >= {least}),
cuts AS (SELECT c.lang, c.p, c.a, k, x.f AS l, y.f AS r, ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, n)) AS k FROM cand) c JOIN grams x ON x.lang = c.lang AND x.p = list_slice(c.p, 1, k)
  JOIN grams y ON y.lang = c.lang AND y.p = list_slice(c.p, k + 1, c.n)),
best AS (SELECT lang, p, a, min((score, k, l, r)) AS m FROM cuts GROUP BY lang, p, a),
around AS (SELECT lang, p, max(a) AS longer FROM (
  SELECT lang, a, unnest([list_slice(p, 1, 2), list_slice(p, 2, 3)]) AS p FROM cand WHERE n = 3) GROUP BY lang, p),
kept AS (SELECT b.lang, array_to_string(b.p, ' ') AS phrase, a, m[3] AS l, m[4] AS r, m[1] AS score
  FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.p = b.p WHERE o.longer IS NULL OR 100 * o.longer < {within} * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, s.n, score
FROM kept JOIN size s USING (lang) QUALIFY rank <= {top}"""


#: The other operators draw, learn, tokenize or parse, which SQL cannot express; they are
#: tested against brute force, exact round trips or held-out accuracy.
ORACLES: dict[str, str] = {"op9_line_dedup": _sql_op9(), "op10_ngram_jaccard_join": _sql_op10(),
                            "op11_centroid_clustering": _sql_op11(), "op12_phrase_collocations": _sql_op12()}
