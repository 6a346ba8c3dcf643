"""The query catalog: one Spark plan per operator key, and its DuckDB oracle SQL.

Every query reads whole test tables (or data Spark derives from them); limits appear only
where the limit is the operator (``scan_limit``, ``nonnull_preview``, top-k searches).
Column names and types match between a query and its oracle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions import text as T
from cadenza.functions import vectors as VF
from cadenza.operators import embed as E
from cadenza.operators import index as X
from cadenza.operators import knn as K
from cadenza.operators import label as L
from cadenza.operators import measures as M
from cadenza.operators import phrase_tags as PH
from cadenza.operators import prompts as P
from cadenza.plans import oracle as O
from cadenza.plans.recommend import recommend, song_vectors
from cadenza.session import local_frame, scratch_path
from cadenza.sources import files as io
from cadenza.sources import fixtures as fx
from cadenza.sources.tables import read_table, scan_limit, sentences, songs, songs_from_documents
from cadenza.streaming import index_stream as S

DIM = E.DEFAULT_DIM          # song vectors: the reference's width
EMB_DIM = 64                 # width of the `embeddings` test table
KNN = 10                     # results per query
SAMPLE_FRACTION = 0.2        # the reference's sample fraction
BLOCK_BYTES = 250_000        # query bytes per block in the block path's key
IVF_CELLS = 16               # cells of the inverted file

# Our label prompt.
LABEL_PROMPT = "List ten moods of this song as [a, b, ...].\nSong: {input}\nMoods: "

# The reference's own trial sentences (fixed values, in its order).
TRIAL_SENTENCES = (
    "I am in love!",
    "It's been a long, rainy winter.",
    "The barista got my order wrong. I am furious.",
    "I can't believe that awful man won the lottery. Life is unfair.",
)

Query = Callable[[SparkSession, str], DataFrame]


# ----------------------------------------------------------------------------- helpers

def lexicon(spark: SparkSession, d: str) -> DataFrame:
    return L.materialize_lexicon(L.build_lexicon(read_table(spark, d, "documents")))


def labeled(spark: SparkSession, d: str, lex: DataFrame | None = None, cleaner: str | None = "v2") -> DataFrame:
    """artist, song, link, llm_labeled_emotions (no text)."""
    lex = lex if lex is not None else lexicon(spark, d)
    return L.label_emotions(songs(spark, d), lex, cleaner=cleaner).drop("text")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table, read back: models run once, whatever reads it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved_labels(spark: SparkSession, d: str) -> DataFrame:
    return saved(labeled(spark, d), "labeled")


def vectors(spark: SparkSession, d: str, lex: DataFrame | None = None) -> DataFrame:
    return E.embed(labeled(spark, d, lex), dim=DIM)


def index_of(rows: DataFrame, lex: DataFrame, **options) -> DataFrame:
    """The index of song rows, from their saved embeddings."""
    return X.build_index(saved(song_vectors(rows, lex, dim=DIM), "embeddings"), dim=DIM, check_dim=False, **options)


def song_index(spark: SparkSession, d: str, lex: DataFrame) -> DataFrame:
    return index_of(songs(spark, d), lex)


INDEX_COLUMNS = ("artist", "song", "link", "llm_labeled_emotions", "norm")


def embeddings(spark: SparkSession, d: str) -> DataFrame:
    """The embeddings dealt to all cores and saved: searches of all pairs read them several times, and
    a file's row groups may be fewer than its splits."""
    e = read_table(spark, d, "embeddings")
    return saved(e.repartition(2 * spark.sparkContext.defaultParallelism), "vectors")


def embedding_queries(e: DataFrame) -> DataFrame:
    return e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))


# ----------------------------------------------------------------------------- queries

def q_scan_songs(spark, d):
    """The songs table, every row."""
    return songs(spark, d)


def q_scan_limit(spark, d):
    """S3: ``select * ... limit 3``, made repeatable by ordering on the key."""
    return scan_limit(songs(spark, d), "link", 3)


def q_csv_scan(spark, d):
    """Songs written as CSV, read back with the song file's options."""
    path = scratch_path(spark, "songs-csv")
    io.write_csv(songs(spark, d), path)
    return io.read_songs_csv(spark, path)


NAMESPACE = "cadenza"


def q_csv_sample_table(spark, d):
    """Write the songs as CSV, then ingest: read it, keep the hash sample, save the table."""
    csv = io.write_csv(songs(spark, d), scratch_path(spark, "songs-csv"))
    io.ensure_namespace(spark, NAMESPACE)
    name = f"{NAMESPACE}.sampled_{uuid.uuid4().hex[:12]}"
    return io.ingest_songs(spark, csv, name, scratch_path(spark, "table-sampled"), SAMPLE_FRACTION)


def q_table_overwrite(spark, d):
    """A table written with four columns in the used namespace, overwritten with five
    under its full name, read back."""
    short = f"songs_{uuid.uuid4().hex[:12]}"
    name, path = f"{NAMESPACE}.{short}", scratch_path(spark, "table-songs")
    before = io.use_namespace(spark, NAMESPACE)
    try:
        io.overwrite_table(songs(spark, d), short, path)            # first: four columns
    finally:
        io.use_namespace(spark, before)
    lex = lexicon(spark, d)
    relabeled = L.label_emotions(songs(spark, d), lex)              # then: five columns
    return io.overwrite_table(relabeled, name, path)


def q_sample_songs(spark, d):
    """L4: the hash sample of the songs (fraction 0.2)."""
    return M.sample_by_key(songs(spark, d), "link", SAMPLE_FRACTION)


def q_sample_count(spark, d):
    """A1: the number of sampled songs."""
    return M.sample_by_key(songs(spark, d), "link", SAMPLE_FRACTION).agg(F.count(F.lit(1)).alias("n_songs"))


def q_nonnull_preview(spark, d):
    """Not-null filter, then the first 200 rows by key."""
    s = fx.songs_with_nulls(read_table(spark, d, "documents"))
    return scan_limit(s.where(F.col("text").isNotNull()), "link", 200)


def q_strip_punct(spark, d):
    """ASCII punctuation removed from every conversation turn."""
    c = read_table(spark, d, "conversations")
    return c.select("conv_id", "turn", T.strip_punct("text").alias("clean_text"))


def q_word_count(spark, d):
    """words per conversation turn, as Python's ``split()`` counts them."""
    c = read_table(spark, d, "conversations")
    return c.select("conv_id", "turn", T.word_count("text").alias("n_words"))


def q_clean_v1(spark, d):
    """cleaner v1 over the model answers."""
    a = fx.model_answers(read_table(spark, d, "documents"))
    return a.select("doc_id", T.clean_v1("answer").alias("cleaned"))


def q_clean_v2(spark, d):
    """Cleaner v2 over the model answers."""
    a = fx.model_answers(read_table(spark, d, "documents"))
    return a.select("doc_id", T.clean_v2("answer").alias("cleaned"))


def q_clean_v2_legacy(spark, d):
    """F7 (D2): cleaner v2 keeping the skip-after-remove behaviour."""
    a = fx.model_answers(read_table(spark, d, "documents"))
    return a.select("doc_id", T.clean_v2("answer", legacy_skip=True).alias("cleaned"))


def q_render_prompt(spark, d):
    """the label prompt rendered for every document."""
    docs = read_table(spark, d, "documents")
    return docs.select("doc_id", T.render_prompt("text", LABEL_PROMPT).alias("prompt"))


def q_label_emotions(spark, d):
    """The four song columns plus the labels."""
    return L.label_emotions(songs(spark, d), lexicon(spark, d))


def q_first_label(spark, d):
    """``select(label).first()[0]`` made repeatable (P3, L2), then that one label encoded
    (M5: the embedder on a one-row frame): its non-zero entries and norm."""
    row = L.label_emotions(scan_limit(songs(spark, d), "link", 1), lexicon(spark, d))
    first = row.select("link", "llm_labeled_emotions")
    vec = E.embed(first, dim=DIM)
    return vec.select("link", "llm_labeled_emotions",
                      F.size(F.filter("emotions_embeddings", lambda v: v != 0)).alias("nnz"), "norm")


def q_label_error_rows(spark, d):
    """P5: songs whose label holds ERROR."""
    return M.error_rows(saved_labels(spark, d))


def q_label_error_rate(spark, d):
    """A2, A3: songs, error rows and the error rate in percent."""
    return M.error_rate(saved_labels(spark, d))


def q_label_form(spark, d):
    """label items, distinct items and whether they are ten distinct words."""
    return M.label_form(saved_labels(spark, d))


def q_prompt_grid(spark, d):
    """Every song under every prompt, written as JSON and read back."""
    grid = P.prompt_grid(songs(spark, d), lexicon(spark, d))
    return io.write_json(grid, scratch_path(spark, "prompt-grid"))


def q_prompt_compare(spark, d):
    """A5: results per song side by side, one column per prompt."""
    return P.prompt_compare(P.prompt_grid(songs(spark, d), lexicon(spark, d)))


def q_embed_labels(spark, d):
    """The embeddings as (link, bucket, weight) rows."""
    return E.sparse_rows(vectors(spark, d))


def q_embed_dense(spark, d):
    """M4: every entry of every dense vector."""
    return E.dense_rows(vectors(spark, d))


def q_vector_check(spark, d):
    """counts of rows the index would keep out, over vectors of which some are damaged."""
    return X.vector_check(fx.damaged_vectors(saved(vectors(spark, d), "embeddings"), DIM), DIM)


def q_build_index(spark, d):
    """Rows fit for the index, with their norms."""
    return song_index(spark, d, lexicon(spark, d)).select(*INDEX_COLUMNS)


def q_index_with_errors(spark, d):
    """S9 as the reference builds it: rows with ERROR labels are indexed too."""
    return index_of(songs(spark, d), lexicon(spark, d), drop_errors=False).select(*INDEX_COLUMNS)


def q_label_v1(spark, d):
    """M2: labels cleaned by cleaner v1, as the reference's saved table has them."""
    return labeled(spark, d, cleaner="v1")


def q_label_duplicates(spark, d):
    """Every row keeps its own label when links repeat or are null."""
    rows = songs(spark, d).withColumn("link", F.when(F.length("text") % 3 == 0, F.lit(None)).when(
        F.length("text") % 3 == 1, F.lit("/doc/same")).otherwise(F.col("link")))
    return L.label_emotions(rows, lexicon(spark, d)).drop("text")


def q_snapshot_diff(spark, d):
    """Inserted, updated and deleted keys between two snapshots."""
    docs = read_table(spark, d, "documents")
    return X.snapshot_diff(songs_from_documents(docs), fx.next_snapshot(docs))


def q_index_upsert(spark, d):
    """The index after applying the snapshot diff."""
    docs = read_table(spark, d, "documents")
    lex = lexicon(spark, d)
    old, new = songs_from_documents(docs), fx.next_snapshot(docs)
    old_index = saved(index_of(old, lex), "index")
    diff = saved(X.snapshot_diff(old, new), "diff")
    fresh = index_of(X.changed_rows(new, diff), lex)
    return X.upsert(old_index, diff, fresh).select(*INDEX_COLUMNS)


def q_latest_version(spark, d):
    """A4: newest version per name, versions compared as numbers."""
    ev = read_table(spark, d, "events").select("event_type", F.col("user_id").cast("string").alias("version"))
    return X.latest_version(ev, "event_type", "version")


def q_knn_exact(spark, d):
    """Top 10 by cosine for every embedding (broadcast path)."""
    e = embeddings(spark, d)
    return K.knn_search(embedding_queries(e), e, dim=EMB_DIM, k=KNN, query_key="query_id",
                        query_vec="query_vec", index_key="vec_id", index_vec="embedding",
                        exclude_self=True)


def q_knn_block(spark, d):
    """The same through the block path: query blocks pass over the index."""
    e = embeddings(spark, d)
    return K.knn_search(embedding_queries(e), e, dim=EMB_DIM, k=KNN, query_key="query_id",
                        query_vec="query_vec", index_key="vec_id", index_vec="embedding",
                        exclude_self=True, max_broadcast_bytes=BLOCK_BYTES)


def q_knn_l2(spark, d):
    """Nearest neighbours by Euclidean distance (score = minus the distance)."""
    e = embeddings(spark, d)
    return K.knn_search(embedding_queries(e), e, dim=EMB_DIM, k=KNN, query_key="query_id",
                        query_vec="query_vec", index_key="vec_id", index_vec="embedding",
                        metric="l2", exclude_self=True)


def centroid(e: DataFrame, vec: str = "embedding") -> list[float]:
    """Mean vector of the table (one small aggregation; ``dim`` values reach the driver)."""
    rows = (e.select(F.posexplode(vec)).groupBy("pos").agg(F.avg("col").alias("v"))
            .orderBy("pos").collect())
    return [r["v"] for r in rows]


def q_knn_single(spark, d):
    """L3: top 10 for one query vector (the table's centroid)."""
    e = read_table(spark, d, "embeddings")
    return K.knn_single(e, centroid(e), k=KNN, index_key="vec_id", index_vec="embedding")


def q_recommend(spark, d):
    """Every user sentence answered with the ten most similar songs."""
    lex = lexicon(spark, d)
    return recommend(sentences(spark, d), song_index(spark, d, lex), lex, k=KNN, dim=DIM)


def q_recommend_stored(spark, d):
    """The same answers as ``recommend``, through written tables: build the store once, then
    search the stored index."""
    from cadenza.plans import store as PL

    store = PL.build_store(songs(spark, d), scratch_path(spark, "store"), dim=DIM, bucketed=True)
    return PL.recommend_from_store(sentences(spark, d), store, dim=DIM, k=KNN)


def q_recommend_sparse(spark, d):
    """M4, M6: the store with sparse vectors (indices, values), served exactly: same answers
    as ``recommend``."""
    from cadenza.plans import store as PL

    store = PL.build_store(songs(spark, d), scratch_path(spark, "store-sparse"), dim=DIM, sparse=True)
    return PL.recommend_from_store(sentences(spark, d), store, dim=DIM, k=KNN)


def q_recommend_ivf(spark, d):
    """Serving from the stored inverted file: each sentence reads only its 2 nearest of 16
    cells (approximate; rows-only check)."""
    from cadenza.plans import store as PL

    store = PL.build_store(songs(spark, d), scratch_path(spark, "store-ivf"), dim=DIM,
                           bucketed=True, ivf_cells=IVF_CELLS)
    return PL.recommend_from_store(sentences(spark, d), store, dim=DIM, k=KNN, nprobe=2)


def q_recommend_raw(spark, d):
    """M7: the same with the raw sentence embedded instead of its labels."""
    lex = lexicon(spark, d)
    return recommend(sentences(spark, d), song_index(spark, d, lex), lex, k=KNN, dim=DIM,
                     embed_source="raw")


def q_recommend_trials(spark, d):
    """M6: the reference's four trial sentences against all songs."""
    lex = lexicon(spark, d)
    trials = local_frame(spark, [(str(i + 1), s) for i, s in enumerate(TRIAL_SENTENCES)],
                         "query_id string, user_input string")
    return recommend(trials, song_index(spark, d, lex), lex, k=KNN, dim=DIM)


def q_stream_index(spark, d):
    """Two change files, two ``availableNow`` runs: the index ends equal to a batch build of
    the second snapshot."""
    docs = read_table(spark, d, "documents")
    lex = lexicon(spark, d)
    root = scratch_path(spark, "index-stream")
    src, base, ckpt = f"{root}/changes", f"{root}/index", f"{root}/checkpoint"
    old, new = songs_from_documents(docs), fx.next_snapshot(docs)
    S.changes_from_rows(old, seq=1).write.mode("append").parquet(src)
    S.run_index_stream(spark, src, base, ckpt, lex, DIM)
    diff = saved(X.snapshot_diff(old, new), "diff")
    S.changes_from_diff(new, diff, seq=2).write.mode("append").parquet(src)
    return S.run_index_stream(spark, src, base, ckpt, lex, DIM).select(*INDEX_COLUMNS)


def q_stream_on_store(spark, d):
    """An index built in batch, then refreshed by a stream with a checkpoint of its
    own, ends equal to a batch build of the second snapshot."""
    from cadenza.plans import store as PL

    docs = read_table(spark, d, "documents")
    old, new = songs_from_documents(docs), fx.next_snapshot(docs)
    root = scratch_path(spark, "stream-on-store")
    store = PL.build_store(old, f"{root}/store", dim=DIM, bucketed=True)
    diff = saved(X.snapshot_diff(old, new), "diff")
    S.changes_from_diff(new, diff, seq=1).write.parquet(f"{root}/changes")
    return S.run_index_stream(spark, f"{root}/changes", store.index, f"{root}/checkpoint",
                              PL.open_lexicon(spark, store), DIM).select(*INDEX_COLUMNS)


def q_stream_late(spark, d):
    """Older changes to updated and deleted songs arrive late and change nothing, neither in a
    delta nor after a compaction."""
    docs = read_table(spark, d, "documents")
    lex = lexicon(spark, d)
    root = scratch_path(spark, "stream-late")
    src, base, ckpt = f"{root}/changes", f"{root}/index", f"{root}/checkpoint"
    old, new = songs_from_documents(docs), fx.next_snapshot(docs)
    diff = saved(X.snapshot_diff(old, new), "diff")
    changed = old.join(diff.select("link"), "link", "left_semi")
    for rows, compacted in ((S.changes_from_rows(old, seq=1), False), (S.changes_from_diff(new, diff, seq=5), False),
                            (S.changes_from_rows(changed, seq=3), True), (S.changes_from_rows(changed, seq=4), False)):
        rows.write.mode("append").parquet(src)
        index = S.run_index_stream(spark, src, base, ckpt, lex, DIM)
        if compacted:
            X.compact(spark, base)
            X.drop_before(spark, base)
    return index.select(*INDEX_COLUMNS)


def q_stream_recommend(spark, d):
    """Sentences answered by a stream against the stored index: one file of sentences, two
    ``availableNow`` runs (the second finds nothing new), answers equal to ``recommend``."""
    from cadenza.plans import store as PL
    from cadenza.streaming import answer_stream as A

    root = scratch_path(spark, "answer-stream")
    store = PL.build_store(songs(spark, d), f"{root}/store", dim=DIM)
    sentences(spark, d).write.mode("append").parquet(f"{root}/sentences")
    for _ in range(2):
        A.run_answer_stream(spark, f"{root}/sentences", store, f"{root}/answers", f"{root}/checkpoint",
                            k=KNN, dim=DIM)
    return A.read_answers(spark, f"{root}/answers")


def q_exclude_flagged(spark, d):
    """M9: songs without a toxic flag (left anti join)."""
    flags = (read_table(spark, d, "labels").where(F.col("toxic") == 1)
             .select(F.concat(F.lit("/doc/"), F.col("doc_id").cast("string")).alias("link")))
    return M.exclude_flagged(songs(spark, d), flags)


def q_holiday_tag(spark, d):
    """M9: songs tagged when their text holds a holiday word."""
    return M.holiday_tag(fx.songs_with_holidays(read_table(spark, d, "documents"))).select("link", "is_holiday")


QUERIES: dict[str, Query] = {
    "scan_songs": q_scan_songs,
    "scan_limit": q_scan_limit,
    "csv_scan": q_csv_scan,
    "table_overwrite": q_table_overwrite,
    "csv_sample_table": q_csv_sample_table,
    "sample_songs": q_sample_songs,
    "sample_count": q_sample_count,
    "nonnull_preview": q_nonnull_preview,
    "strip_punct": q_strip_punct,
    "word_count": q_word_count,
    "clean_v1": q_clean_v1,
    "clean_v2": q_clean_v2,
    "clean_v2_legacy": q_clean_v2_legacy,
    "render_prompt": q_render_prompt,
    "label_emotions": q_label_emotions,
    "first_label": q_first_label,
    "label_error_rows": q_label_error_rows,
    "label_error_rate": q_label_error_rate,
    "label_form": q_label_form,
    "prompt_grid": q_prompt_grid,
    "prompt_compare": q_prompt_compare,
    "embed_labels": q_embed_labels,
    "embed_dense": q_embed_dense,
    "vector_check": q_vector_check,
    "build_index": q_build_index,
    "index_with_errors": q_index_with_errors,
    "label_v1": q_label_v1,
    "label_duplicates": q_label_duplicates,
    "snapshot_diff": q_snapshot_diff,
    "index_upsert": q_index_upsert,
    "latest_version": q_latest_version,
    "knn_exact": q_knn_exact,
    "knn_block": q_knn_block,
    "knn_l2": q_knn_l2,
    "knn_single": q_knn_single,
    "recommend": q_recommend,
    "recommend_stored": q_recommend_stored,
    "recommend_sparse": q_recommend_sparse,
    "recommend_ivf": q_recommend_ivf,
    "recommend_raw": q_recommend_raw,
    "recommend_trials": q_recommend_trials,
    "stream_index": q_stream_index,
    "stream_on_store": q_stream_on_store,
    "stream_late": q_stream_late,
    "stream_recommend": q_stream_recommend,
    "exclude_flagged": q_exclude_flagged,
    "holiday_tag": q_holiday_tag,
}


# ----------------------------------------------------------------------------- oracles

PY_WORD_SQL = (r"[^\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
               r"\x{202f}\x{205f}\x{3000}]+")


def _wc(expr: str) -> str:
    return f"CAST(len(regexp_extract_all({expr}, '{PY_WORD_SQL}')) AS INTEGER)"


def _answers_cte() -> str:
    w = "array_to_string(list_slice(list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))), 1, 8 + doc_id % 7), ', ')"
    return f"""answers AS (
  SELECT doc_id, CASE doc_id % 5
      WHEN 0 THEN '[INST] label the ' || lang || ' text [/INST] [' || {w} || ']'
      WHEN 1 THEN 'Sure: ["' || {w} || '"]'
      WHEN 2 THEN text
      WHEN 3 THEN '[' || {w} || chr(10) || '][x]'
      ELSE 'json' || chr(10) || {w} END AS answer
  FROM documents)"""


def _v2_finish(joined: str) -> str:
    s = f"regexp_replace(replace(trim(trim(trim({joined}, '[]'), '\"'), ''''), chr(10), ''), ' +', ' ', 'g')"
    return f"CASE WHEN {_wc(s)} BETWEEN 10 AND 11 THEN {s} ELSE 'ERROR: ' || {s} END"


def _sql_clean_v1() -> str:
    t = f"translate(answer, {O.PUNCT_SQL}, '')"
    for lit in T.V1_DELETED_LITERALS:
        t = f"replace({t}, {'chr(10)' if lit == chr(10) else O.q(lit)}, '')"
    return f"""WITH {_answers_cte()}
SELECT doc_id, CASE WHEN {_wc(t)} > 12 THEN 'LLM OUTPUT ERROR' ELSE {t} END AS cleaned FROM answers"""


def _sql_clean_v2() -> str:
    joined = ("array_to_string(list_filter(regexp_extract_all(lower(answer), '\\[([\\s\\S]*?)\\]', 1), "
              "lambda i: NOT contains(i, 'inst')), ' ')")
    return f"WITH {_answers_cte()}\nSELECT doc_id, {_v2_finish(joined)} AS cleaned FROM answers"


def _sql_clean_v2_legacy() -> str:
    # Within each run of consecutive items holding 'inst', the 1st, 3rd, ... are looked at. Each
    # removes the first equal item that is still there: itself, or a passed-over one before it.
    # So of equal items as many stay as were passed over, and they are the last ones from the
    # first passed-over one on.
    return f"""WITH {_answers_cte()},
g AS (SELECT doc_id, regexp_extract_all(lower(answer), '\\[([\\s\\S]*?)\\]', 1) AS groups FROM answers),
items AS (SELECT doc_id, unnest(groups) AS item, unnest(generate_series(1, len(groups))) AS pos FROM g),
flagged AS (
  SELECT *, contains(item, 'inst') AS c,
         coalesce(max(CASE WHEN NOT contains(item, 'inst') THEN pos END)
                  OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev
  FROM items),
passed AS (SELECT *, c AND (pos - prev - 1) % 2 = 1 AS passed FROM flagged),
equal_items AS (
  SELECT *, sum(CAST(passed AS INTEGER)) OVER (PARTITION BY doc_id, item) AS n_passed,
         row_number() OVER (PARTITION BY doc_id, item ORDER BY pos DESC) AS from_end FROM passed),
kept AS (
  SELECT doc_id, string_agg(item, ' ' ORDER BY pos) AS joined FROM equal_items
  WHERE NOT c OR from_end <= n_passed GROUP BY doc_id)
SELECT g.doc_id, CASE WHEN g.groups IS NULL THEN NULL ELSE {_v2_finish("coalesce(kept.joined, '')")} END AS cleaned
FROM g LEFT JOIN kept USING (doc_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _labeled_prefix() -> str:
    return _with(O.lexicon_cte(), O.songs_cte(), O.label_ctes("labeled", "songs", "link", "text", "llm_labeled_emotions"))


def _vectors_prefix() -> str:
    return _with(O.lexicon_cte(), O.songs_cte(),
                 O.label_ctes("labeled", "songs", "link", "text", "llm_labeled_emotions"),
                 O.sparse_ctes("sp", "labeled", "link", "llm_labeled_emotions", DIM))


def _next_snapshot_cte() -> str:
    return """songs_new AS (
  SELECT source AS artist, 'doc-' || CAST(doc_id AS VARCHAR) AS song, '/doc/' || CAST(doc_id AS VARCHAR) AS link,
         CASE WHEN doc_id < 20 THEN text || ' revised' ELSE text END AS text
  FROM documents WHERE doc_id >= 10
  UNION ALL
  SELECT source, 'doc-new-' || CAST(doc_id AS VARCHAR), '/doc/new-' || CAST(doc_id AS VARCHAR), text
  FROM documents WHERE doc_id < 3)"""


def _emb_cte() -> str:
    return ("emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), "
            f"CAST(embedding AS DOUBLE[]))) AS norm FROM embeddings WHERE len(embedding) = {EMB_DIM} "
            "AND len(list_filter(embedding, lambda x: x IS NULL)) = 0)")


def _sql_knn_exact() -> str:
    return f"""WITH {_emb_cte()},
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, round(list_dot_product(a.v, b.v) / (a.norm * b.norm), 6) AS score
  FROM emb a, emb b WHERE a.vec_id <> b.vec_id AND a.norm > 0 AND b.norm > 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {KNN}"""


def _sql_knn_l2() -> str:
    return f"""WITH {_emb_cte()},
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, -round(list_distance(a.v, b.v), 6) AS score
  FROM emb a, emb b WHERE a.vec_id <> b.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {KNN}"""


def _sql_knn_single() -> str:
    return f"""WITH {_emb_cte()},
cells AS (SELECT unnest(generate_series(0, len(embedding) - 1)) AS pos, unnest(embedding) AS x FROM embeddings),
c AS (SELECT list(v ORDER BY pos) AS cv FROM (SELECT pos, avg(x) AS v FROM cells GROUP BY pos)),
scored AS (
  SELECT e.vec_id, round(list_dot_product(e.v, c.cv) / (sqrt(list_dot_product(c.cv, c.cv)) * e.norm), 6) AS score
  FROM emb e, c WHERE e.norm > 0),
ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT rank, vec_id, score FROM ranked WHERE rank <= {KNN}"""


def _sql_recommend_trials() -> str:
    rows = ", ".join(f"('{i + 1}', {O.q(s)})" for i, s in enumerate(TRIAL_SENTENCES))
    sql = O.recommend_sql(DIM, KNN)
    return sql.replace(O.sentences_cte(), f"sentences AS (SELECT c1 AS query_id, c2 AS user_input FROM (VALUES {rows}) t(c1, c2))")


def _sql_prompt_grid_base() -> str:
    rows = ", ".join(f"({O.q(a)}, {O.q(b)})" for a, b in T.MASK_PROMPTS)
    return _with(O.lexicon_cte(), O.songs_cte(), f"""grid AS (
  SELECT s.artist, s.song, s.link, p.prompt_label, p.prompt, p.prompt || ' ' || s.text AS input
  FROM songs s CROSS JOIN (VALUES {rows}) p(prompt_label, prompt)
), gtok AS (
  SELECT link, prompt_label, unnest(regexp_extract_all(lower(input), '[a-z]+')) AS word FROM grid
), gcnt AS (
  SELECT link, prompt_label, e.emotion, count(*) AS c FROM gtok JOIN lex USING (word) JOIN emo e USING (emotion_id) GROUP BY ALL
), gtop AS (
  SELECT link, prompt_label, emotion AS result FROM (
    SELECT *, row_number() OVER (PARTITION BY link, prompt_label ORDER BY c DESC, emotion) AS rk FROM gcnt) WHERE rk = 1
), graded AS (
  SELECT g.*, t.result FROM grid g LEFT JOIN gtop t USING (link, prompt_label)
)""")


def _sql_prompt_compare() -> str:
    cols = ", ".join(f"max(CASE WHEN prompt_label = {O.q(a)} THEN result END) AS \"{a}\"" for a, _ in T.MASK_PROMPTS)
    return _sql_prompt_grid_base() + f"SELECT link, song, {cols} FROM graded GROUP BY link, song"


def _index_sql(src_cte_sql: str | None = None, with_errors: bool = False) -> str:
    base = O.song_index_ctes(DIM, with_errors=with_errors)
    if src_cte_sql:
        base = base.replace(O.songs_cte("songs", "documents"), src_cte_sql)
    return f"WITH {base}\nSELECT artist, song, link, llm_labeled_emotions, norm FROM idx"


ORACLES: dict[str, str] = {
    "scan_songs": _with(O.songs_cte()) + "SELECT * FROM songs",
    "scan_limit": _with(O.songs_cte()) + "SELECT * FROM songs ORDER BY link LIMIT 3",
    "csv_scan": _with(O.songs_cte()) + "SELECT * FROM songs",
    "table_overwrite": _labeled_prefix() + "SELECT artist, song, link, text, llm_labeled_emotions FROM labeled",
    "sample_songs": _with(O.songs_cte()) + f"SELECT * FROM songs WHERE {O.hex_int('link', 1, 8)} < 858993459",
    "csv_sample_table": _with(O.songs_cte()) + f"SELECT * FROM songs WHERE {O.hex_int('link', 1, 8)} < 858993459",
    "sample_count": _with(O.songs_cte()) + f"SELECT count(*) AS n_songs FROM songs WHERE {O.hex_int('link', 1, 8)} < 858993459",
    "nonnull_preview": _with(O.songs_cte("songs", "(SELECT doc_id, source, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE text END AS text FROM documents)"))
    + "SELECT * FROM songs WHERE text IS NOT NULL ORDER BY link LIMIT 200",
    "strip_punct": f"SELECT conv_id, turn, translate(text, {O.PUNCT_SQL}, '') AS clean_text FROM conversations",
    "word_count": f"SELECT conv_id, turn, {_wc('text')} AS n_words FROM conversations",
    "clean_v1": _sql_clean_v1(),
    "clean_v2": _sql_clean_v2(),
    "clean_v2_legacy": _sql_clean_v2_legacy(),
    "render_prompt": f"SELECT doc_id, replace({O.q(LABEL_PROMPT)}, '{{input}}', text) AS prompt FROM documents",
    "label_emotions": _labeled_prefix() + "SELECT artist, song, link, text, llm_labeled_emotions FROM labeled",
    "first_label": _with(O.lexicon_cte(), O.songs_cte(), O.label_ctes("labeled", "songs", "link", "text", "llm_labeled_emotions"),
                         "first AS (SELECT link, llm_labeled_emotions FROM labeled ORDER BY link LIMIT 1)",
                         O.sparse_ctes("sp", "first", "link", "llm_labeled_emotions", DIM))
    + """SELECT f.link, f.llm_labeled_emotions, CAST(count(sp.bucket) AS INTEGER) AS nnz,
  coalesce(sqrt(sum(sp.weight * sp.weight)), 0.0) AS norm
FROM first f LEFT JOIN sp USING (link) GROUP BY f.link, f.llm_labeled_emotions""",
    "label_error_rows": _labeled_prefix() + "SELECT artist, song, link, llm_labeled_emotions FROM labeled WHERE contains(llm_labeled_emotions, 'ERROR')",
    "label_error_rate": _labeled_prefix() + """SELECT count(*) AS n_songs,
  count(*) FILTER (WHERE contains(llm_labeled_emotions, 'ERROR')) AS n_errors,
  round(count(*) FILTER (WHERE contains(llm_labeled_emotions, 'ERROR')) / count(*), 2) * 100 AS error_pct FROM labeled""",
    "label_form": _labeled_prefix() + """SELECT link, CAST(len(string_split_regex(llm_labeled_emotions, ', *')) AS INTEGER) AS n_items,
  CAST(len(list_distinct(string_split_regex(llm_labeled_emotions, ', *'))) AS INTEGER) AS n_distinct,
  (NOT contains(llm_labeled_emotions, 'ERROR') AND len(string_split_regex(llm_labeled_emotions, ', *')) = 10
   AND len(list_distinct(string_split_regex(llm_labeled_emotions, ', *'))) = 10) AS well_formed FROM labeled""",
    "prompt_grid": _sql_prompt_grid_base() + "SELECT artist, song, link, prompt_label, prompt, input, result FROM graded",
    "prompt_compare": _sql_prompt_compare(),
    "embed_labels": _vectors_prefix() + "SELECT link, bucket, weight FROM sp",
    "embed_dense": _vectors_prefix() + f"""SELECT l.link, r.pos, coalesce(sp.weight, 0.0) AS value
FROM labeled l CROSS JOIN (SELECT range AS pos FROM range({DIM})) r
LEFT JOIN sp ON sp.link = l.link AND sp.bucket = r.pos""",
    "vector_check": _vectors_prefix() + """SELECT count(*) AS n_rows, count(*) FILTER (WHERE no % 11 = 0) AS n_null_vector,
  count(*) FILTER (WHERE no % 11 <> 0 AND no % 13 = 0) AS n_wrong_dim,
  count(*) FILTER (WHERE no % 11 <> 0 AND no % 13 <> 0 AND (no % 17 = 0 OR zero AND no % 19 <> 0 AND no % 23 <> 0)) AS n_zero_norm,
  count(*) FILTER (WHERE no % 11 <> 0 AND no % 13 <> 0 AND no % 17 <> 0 AND (no % 19 = 0 OR no % 23 = 0)) AS n_not_finite,
  count(*) FILTER (WHERE contains(llm_labeled_emotions, 'ERROR')) AS n_error_label,
  count(*) - count(DISTINCT link) AS n_duplicate_key
FROM (SELECT *, CAST(regexp_extract(link, '([0-9]+)$', 1) AS BIGINT) AS no, link NOT IN (SELECT link FROM sp_norm) AS zero FROM labeled)""",
    "build_index": _index_sql(),
    "index_with_errors": _index_sql(with_errors=True),
    "label_v1": _with(O.lexicon_cte(), O.songs_cte(), O.label_ctes(
        "labeled", "songs", "link", "text", "llm_labeled_emotions", "replace(coalesce(t.names, ''), ',', '')"))
    + "SELECT artist, song, link, llm_labeled_emotions FROM labeled",
    "label_duplicates": _labeled_prefix() + """SELECT artist, song, CASE length(text) % 3 WHEN 0 THEN NULL WHEN 1 THEN '/doc/same' ELSE link END AS link,
  llm_labeled_emotions FROM labeled""",
    "snapshot_diff": _with(O.songs_cte(), _next_snapshot_cte()) + """SELECT coalesce(o.link, n.link) AS link,
  CASE WHEN o.link IS NULL THEN 'insert' WHEN n.link IS NULL THEN 'delete' ELSE 'update' END AS change
FROM songs o FULL OUTER JOIN songs_new n ON o.link = n.link
WHERE o.link IS NULL OR n.link IS NULL OR o.artist IS DISTINCT FROM n.artist
   OR o.song IS DISTINCT FROM n.song OR o.text IS DISTINCT FROM n.text""",
    "index_upsert": _index_sql(_next_snapshot_cte().replace("songs_new AS", "songs AS", 1)),
    "stream_index": _index_sql(_next_snapshot_cte().replace("songs_new AS", "songs AS", 1)),
    "stream_late": _index_sql(_next_snapshot_cte().replace("songs_new AS", "songs AS", 1)),
    "stream_on_store": _index_sql(_next_snapshot_cte().replace("songs_new AS", "songs AS", 1)),
    "latest_version": "SELECT event_type, max(TRY_CAST(CAST(user_id AS VARCHAR) AS BIGINT)) AS latest_version, "
    "count(*) FILTER (WHERE TRY_CAST(CAST(user_id AS VARCHAR) AS BIGINT) IS NULL) AS n_rejected FROM events GROUP BY event_type",
    "knn_exact": _sql_knn_exact(),
    "knn_block": _sql_knn_exact(),
    "knn_l2": _sql_knn_l2(),
    "knn_single": _sql_knn_single(),
    "recommend": O.recommend_sql(DIM, KNN),
    "recommend_stored": O.recommend_sql(DIM, KNN),
    "stream_recommend": O.recommend_sql(DIM, KNN),
    "recommend_sparse": O.recommend_sql(DIM, KNN),
    "recommend_raw": O.recommend_sql(DIM, KNN, embed_source="raw"),
    "recommend_trials": _sql_recommend_trials(),
    "exclude_flagged": _with(O.songs_cte()) + """SELECT * FROM songs s WHERE NOT EXISTS (
  SELECT 1 FROM labels l WHERE l.toxic = 1 AND '/doc/' || CAST(l.doc_id AS VARCHAR) = s.link)""",
    "holiday_tag": _with(O.songs_cte("songs", "(SELECT doc_id, source, CASE WHEN doc_id % 9 = 0 THEN text || ' Merry Christmas!' ELSE text END AS text FROM documents)"))
    + "SELECT link, coalesce(list_has_any(regexp_extract_all(lower(text), '[a-z]+'), ["
    + ", ".join(O.q(w) for w in M.HOLIDAY_WORDS) + "]), false) AS is_holiday FROM songs",
}


# ----------------------------------------------------------------------------- approximate search

IVF_PROBES = (1, 2, 4, 8, IVF_CELLS)


def q_knn_bad_vectors(spark, d):
    """Rows with null, short, zero, NaN or infinite vectors take no part, for every metric
    and on both paths."""
    e = embeddings(spark, d).select("vec_id", "embedding", F.concat(F.lit("/"), F.col("vec_id").cast("string")).alias("link"))
    bad = saved(fx.damaged_vectors(e, EMB_DIM, "embedding"), "bad-vectors")
    out = None
    for metric in ("cosine", "dot", "l2"):
        for path, size in (("broadcast", K.DEFAULT_BROADCAST_BYTES), ("block", BLOCK_BYTES)):
            hits = K.knn_search(embedding_queries(bad), bad, dim=EMB_DIM, k=KNN, query_key="query_id", query_vec="query_vec",
                                index_key="vec_id", index_vec="embedding", metric=metric, exclude_self=True,
                                max_broadcast_bytes=size)
            hits = hits.withColumn("metric", F.lit(metric)).withColumn("path", F.lit(path))
            out = hits if out is None else out.unionByName(hits)
    return out


def _ivf_inputs(spark, d):
    from cadenza.operators import ivf as V

    e = read_table(spark, d, "embeddings")
    model = V.hash_pivots(e, "embedding", EMB_DIM, IVF_CELLS, "vec_id")
    path = V.write_cells(e, model, scratch_path(spark, "ivf-cells"), dim=EMB_DIM, index_key="vec_id", index_vec="embedding")

    def search(nprobe: int):
        return V.ivf_search_stored(embedding_queries(e), path, model, dim=EMB_DIM, k=KNN, nprobe=nprobe,
                                   query_key="query_id", query_vec="query_vec", index_key="vec_id",
                                   index_vec="embedding", exclude_self=True)

    return V, search


def q_knn_ivf(spark, d):
    """M8: inverted lists written by cell, then searched reading only the 2 probed cells."""
    return _ivf_inputs(spark, d)[1](2)[0]


def q_knn_ivf_all(spark, d):
    """M8: with every cell probed the answers are those of exact search."""
    return _ivf_inputs(spark, d)[1](IVF_CELLS)[0]


def q_knn_recall(spark, d):
    """M8: recall@10 and share of pairs scored, per number of probed cells."""
    V, search = _ivf_inputs(spark, d)
    exact = saved(q_knn_exact(spark, d), "knn-exact")
    out = None
    for nprobe in IVF_PROBES:
        approx, share = search(nprobe)
        row = V.ivf_recall(exact, approx, "query_id", "vec_id").select(
            F.lit(IVF_CELLS).alias("n_cells"), F.lit(nprobe).alias("nprobe"), "recall", F.lit(share).alias("pairs_scored"))
        out = row if out is None else out.unionByName(row)
    return out


def _pruned_inputs(spark, d):
    from cadenza.operators import ivf as V

    e = read_table(spark, d, "embeddings")
    model = V.hash_pivots(e, "embedding", EMB_DIM, IVF_CELLS, "vec_id")
    path = V.write_cells(e, model, scratch_path(spark, "pruned-cells"), dim=EMB_DIM, index_key="vec_id", index_vec="embedding")
    return V.pruned_search(embedding_queries(e), path, model, dim=EMB_DIM, k=KNN, query_key="query_id", query_vec="query_vec",
                           index_key="vec_id", index_vec="embedding", exclude_self=True)


def q_knn_pruned(spark, d):
    """Exact search that skips the cells which the triangle inequality rules out."""
    return _pruned_inputs(spark, d)[0]


def q_ivf_after_stream(spark, d):
    """An inverted file of the first snapshot; a stream changes the index; the file gets the
    changes as a delta of cells and serves the answers of the second snapshot."""
    from cadenza.plans import store as PL

    docs = read_table(spark, d, "documents")
    old, new = songs_from_documents(docs), fx.next_snapshot(docs)
    root = scratch_path(spark, "ivf-stream")
    store = PL.build_store(old, f"{root}/store", dim=DIM, ivf_cells=IVF_CELLS)
    diff = saved(X.snapshot_diff(old, new), "diff")
    S.changes_from_diff(new, diff, seq=1).write.parquet(f"{root}/changes")
    S.run_index_stream(spark, f"{root}/changes", store.index, f"{root}/checkpoint", PL.open_lexicon(spark, store), DIM)
    return PL.recommend_from_store(sentences(spark, d), store, dim=DIM, k=KNN, nprobe=IVF_CELLS)


QUERIES |= {"knn_pruned": q_knn_pruned, "ivf_after_stream": q_ivf_after_stream}
QUERIES |= {"knn_bad_vectors": q_knn_bad_vectors, "knn_ivf": q_knn_ivf, "knn_ivf_all": q_knn_ivf_all,
            "knn_recall": q_knn_recall}


def _ivf_ctes(probes: str) -> str:
    """emb, every vector's cell, the probed cells of every query (``probes``: rank condition)."""
    return f"""{_emb_cte()},
piv AS (SELECT CAST(row_number() OVER (ORDER BY {O.hex_int('CAST(vec_id AS VARCHAR)', 1, 8)}, vec_id) - 1 AS INTEGER) AS cell, v, norm
        FROM emb WHERE norm > 0 QUALIFY cell < {IVF_CELLS}),
near AS (SELECT e.vec_id, p.cell, row_number() OVER (PARTITION BY e.vec_id ORDER BY
           round(list_dot_product(e.v, p.v) / (e.norm * p.norm), 6) DESC, p.cell) AS nth FROM emb e, piv p WHERE e.norm > 0),
cells AS (SELECT vec_id, cell FROM near WHERE nth = 1),
probed AS (SELECT vec_id, cell, nth FROM near WHERE {probes})"""


def _sql_knn_ivf() -> str:
    return f"""WITH {_ivf_ctes("nth <= 2")},
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, round(list_dot_product(a.v, b.v) / (a.norm * b.norm), 6) AS score
  FROM probed p JOIN cells c USING (cell) JOIN emb a ON a.vec_id = p.vec_id JOIN emb b ON b.vec_id = c.vec_id
  WHERE a.vec_id <> b.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {KNN}"""


def _sql_knn_recall() -> str:
    return f"""WITH {_ivf_ctes("TRUE")},
dots AS MATERIALIZED (
  SELECT a.vec_id AS query_id, b.vec_id, round(list_dot_product(a.v, b.v) / (a.norm * b.norm), 6) AS score
  FROM emb a, emb b WHERE a.vec_id <> b.vec_id AND a.norm > 0 AND b.norm > 0),
scored AS (
  SELECT d.query_id, d.vec_id, p.nth, d.score
  FROM dots d JOIN cells c ON c.vec_id = d.vec_id JOIN probed p ON p.vec_id = d.query_id AND p.cell = c.cell),
exact AS (SELECT query_id, vec_id FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {KNN}),
probes AS (SELECT * FROM (VALUES {', '.join(f'({n})' for n in IVF_PROBES)}) t(nprobe)),
approx AS (SELECT nprobe, query_id, vec_id FROM scored JOIN probes ON nth <= nprobe
           QUALIFY row_number() OVER (PARTITION BY nprobe, query_id ORDER BY score DESC, vec_id) <= {KNN}),
share AS (SELECT nprobe, count(*) / (SELECT pow(count(*), 2) FROM cells) AS pairs_scored
          FROM probes JOIN probed ON nth <= nprobe JOIN cells USING (cell) GROUP BY nprobe)
SELECT {IVF_CELLS} AS n_cells, s.nprobe, count(a.query_id) / count(*) AS recall, any_value(s.pairs_scored) AS pairs_scored
FROM share s CROSS JOIN exact e LEFT JOIN approx a ON a.nprobe = s.nprobe AND a.query_id = e.query_id AND a.vec_id = e.vec_id
GROUP BY s.nprobe"""


def _sql_knn_bad_vectors() -> str:
    fine = "vec_id % 11 <> 0 AND vec_id % 13 <> 0 AND vec_id % 17 <> 0 AND vec_id % 19 <> 0 AND vec_id % 23 <> 0"
    score = {"cosine": "list_dot_product(a.v, b.v) / (a.norm * b.norm)", "dot": "list_dot_product(a.v, b.v)"}
    parts = []
    for metric in ("cosine", "dot", "l2"):
        expr = f"round({score[metric]}, 6)" if metric in score else "-round(list_distance(a.v, b.v), 6)"
        # the zero vectors (vec_id % 17 = 0) take part where a norm is not divided by
        zero = "" if metric == "cosine" else " OR zero"
        parts.append(f"""SELECT '{metric}' AS metric, a.vec_id AS query_id, b.vec_id, {expr} AS score FROM bad a, bad b
  WHERE a.vec_id <> b.vec_id AND (a.fine{zero.replace('zero', 'a.zero')}) AND (b.fine{zero.replace('zero', 'b.zero')})""")
    zero = "vec_id % 11 <> 0 AND vec_id % 13 <> 0 AND vec_id % 17 = 0"
    return f"""WITH {_emb_cte()},
bad AS (SELECT vec_id, {fine} AND norm > 0 AS fine, {zero} OR ({fine} AND norm = 0) AS zero, norm,
        CASE WHEN {zero} THEN list_transform(v, lambda x: 0.0::DOUBLE) ELSE v END AS v FROM emb),
scored AS ({" UNION ALL ".join(parts)}),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY metric, query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score, metric, path FROM ranked CROSS JOIN (VALUES ('broadcast'), ('block')) t(path) WHERE rank <= {KNN}"""


def _sql_recommend_ivf() -> str:
    """The exact SQL, with pairs restricted to the probed cells."""
    sql = O.recommend_sql(DIM, KNN)
    cells = f"""piv AS (SELECT link AS plink, CAST(row_number() OVER (ORDER BY {O.hex_int('link', 1, 8)}, link) - 1 AS INTEGER) AS cell, norm AS pn
        FROM dsp_norm QUALIFY cell < {IVF_CELLS}),
pdot AS (SELECT a.id, p.cell, sum(a.weight * d.weight) AS dot
         FROM (SELECT query_id AS id, bucket, weight FROM qsp UNION ALL SELECT link, bucket, weight FROM dsp) a
         JOIN dsp d USING (bucket) JOIN piv p ON p.plink = d.link GROUP BY ALL),
near AS (SELECT n.id, p.cell, row_number() OVER (PARTITION BY n.id ORDER BY round(coalesce(t.dot, 0) / (n.norm * p.pn), 6) DESC, p.cell) AS nth
         FROM (SELECT query_id AS id, norm FROM qsp_norm UNION ALL SELECT link, norm FROM dsp_norm) n CROSS JOIN piv p
         LEFT JOIN pdot t ON t.id = n.id AND t.cell = p.cell),
pairs AS ("""
    sql = sql.replace("pairs AS (", cells, 1)
    return sql.replace("FROM qsp_norm a CROSS JOIN dsp_norm b", """FROM qsp_norm a JOIN near q ON q.id = a.query_id AND q.nth <= 2
  JOIN near c ON c.cell = q.cell AND c.nth = 1 JOIN dsp_norm b ON b.link = c.id""")


ORACLES |= {"knn_ivf": _sql_knn_ivf(), "knn_ivf_all": _sql_knn_exact(), "knn_recall": _sql_knn_recall(),
            "knn_bad_vectors": _sql_knn_bad_vectors(), "recommend_ivf": _sql_recommend_ivf()}
# songs of the second snapshot, labelled with the lexicon of the first
ORACLES |= {"knn_pruned": _sql_knn_exact(),
            "ivf_after_stream": O.recommend_sql(DIM, KNN).replace(O.songs_cte(), _next_snapshot_cte().replace("songs_new AS", "songs AS", 1))}


# ----------------------------------------------------------------------------- product quantisation

PQ_PARTS, PQ_ENTRIES, PQ_ROUNDS, PQ_RERANK = 16, 64, 3, 100
PQ_RERANKS = (20, 50, PQ_RERANK)


def _pq_inputs(spark, d):
    """The embeddings' coded index, and its search at a number of re-ranked rows."""
    from cadenza.operators import pq as Q

    e = embeddings(spark, d)
    books = Q.train_books(e, dim=EMB_DIM, parts=PQ_PARTS, entries=PQ_ENTRIES, rounds=PQ_ROUNDS,
                          index_key="vec_id", index_vec="embedding")
    path = Q.write_codes(e, books, scratch_path(spark, "pq"), index_key="vec_id", index_vec="embedding")
    codes = spark.read.parquet(f"{path}/codes")
    return e, lambda rerank: Q.pq_search(embedding_queries(e), e, codes, Q.Books.load(spark, f"{path}/books"), k=KNN, rerank=rerank,
                                         index_key="vec_id", index_vec="embedding", exclude_self=True)


def q_knn_pq(spark, d):
    """M8: top k by product quantisation: byte codes are scanned, the best estimates are re-ranked."""
    return _pq_inputs(spark, d)[1](PQ_RERANK)


def q_knn_pq_recall(spark, d):
    """M8: recall@10 and re-ranked rows per query, at several numbers of re-ranked rows."""
    from cadenza.operators import ivf as V

    search = _pq_inputs(spark, d)[1]
    exact = saved(q_knn_exact(spark, d), "knn-exact")
    out = None
    for rerank in PQ_RERANKS:
        row = V.ivf_recall(exact, search(rerank), "query_id", "vec_id").select(F.lit(rerank).alias("rerank"), "recall")
        out = row if out is None else out.unionByName(row)
    return out


def _pq_ctes() -> str:
    """int vectors, the books after every round, and every vector's decoded form (``vec_id, i, dec, v, norm``)."""
    width = EMB_DIM // PQ_PARTS
    sums = ", ".join(f"CAST(floor(sum(p[{i}]) / count(*)) AS BIGINT)" for i in range(1, width + 1))
    far = " + ".join(f"(p[{i}] - c[{i}]) * (p[{i}] - c[{i}])" for i in range(1, width + 1))

    def nearest(r: int) -> str:
        return f"SELECT vec_id, part, any_value(p) AS p, min(({far}) * 256 + entry) % 256 AS entry FROM piece JOIN book{r} USING (part) GROUP BY vec_id, part"

    ctes = [f"""{_emb_cte()},
ints AS (SELECT vec_id, v, norm, list_transform(v, lambda x: CAST(floor(x / norm * 4096) AS BIGINT)) AS i FROM emb WHERE norm > 0),
piece AS MATERIALIZED (SELECT vec_id, part, i[part * {width} + 1 : part * {width} + {width}] AS p FROM ints, range({PQ_PARTS}) t(part)),
piv AS (SELECT vec_id, row_number() OVER (ORDER BY {O.hex_int('CAST(vec_id AS VARCHAR)', 1, 8)}, vec_id) - 1 AS entry FROM emb
        WHERE norm > 0 QUALIFY entry < {PQ_ENTRIES}),
book0 AS MATERIALIZED (SELECT part, entry, p AS c FROM piv JOIN piece USING (vec_id))"""]
    for r in range(PQ_ROUNDS):
        ctes.append(f"""book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(n.c, b.c) AS c FROM book{r} b
  LEFT JOIN (SELECT part, entry, [{sums}] AS c FROM ({nearest(r)}) GROUP BY part, entry) n ON n.part = b.part AND n.entry = b.entry)""")
    ctes.append(f"""decoded AS MATERIALIZED (
  SELECT vec_id, CAST(flatten(list(c ORDER BY part)) AS DOUBLE[]) AS dec
  FROM ({nearest(PQ_ROUNDS)}) JOIN book{PQ_ROUNDS} USING (part, entry) GROUP BY vec_id),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS query_id, b.vec_id, round(list_dot_product(a.v, b.v) / (a.norm * b.norm), 6) AS score,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY list_dot_product(CAST(a.i AS DOUBLE[]), dec) DESC, b.vec_id) AS nth
  FROM ints a, ints b JOIN decoded ON decoded.vec_id = b.vec_id WHERE a.vec_id <> b.vec_id)""")
    return ",\n".join(ctes)


def _sql_knn_pq() -> str:
    return f"""WITH {_pq_ctes()}
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs WHERE nth <= {PQ_RERANK} QUALIFY rank <= {KNN}"""


def _sql_knn_pq_recall() -> str:
    return f"""WITH {_pq_ctes()},
exact AS (SELECT query_id, vec_id, nth FROM pairs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {KNN}),
depth AS (SELECT * FROM (VALUES {', '.join(f'({n})' for n in PQ_RERANKS)}) t(rerank))
SELECT rerank, count(*) FILTER (WHERE nth <= rerank) / count(*) AS recall FROM depth, exact GROUP BY rerank"""


QUERIES |= {"knn_pq": q_knn_pq, "knn_pq_recall": q_knn_pq_recall}
ORACLES |= {"knn_pq": _sql_knn_pq(), "knn_pq_recall": _sql_knn_pq_recall()}


# ----------------------------------------------------------------------------- versions of the index

def _versioned_index(spark, d) -> str:
    """An index in four versions: a base of the first snapshot, a delta to the second, a compaction,
    and a delta back to the first."""
    docs = read_table(spark, d, "documents")
    lex = lexicon(spark, d)
    old, new = songs_from_documents(docs), fx.next_snapshot(docs)
    base = scratch_path(spark, "versions")
    X.write_version(index_of(old, lex).select(*INDEX_COLUMNS), base)
    forth = saved(X.snapshot_diff(old, new), "diff")
    back = forth.withColumn("change", F.when(F.col("change") == X.INSERT, X.DELETE).when(F.col("change") == X.DELETE, X.INSERT)
                            .otherwise(F.col("change")))
    X.write_version(S.delta_of(S.changes_from_diff(new, forth, seq=1), lex, DIM), base, X.DELTA)
    X.compact(spark, base)
    X.write_version(S.delta_of(S.changes_from_diff(old, back, seq=2), lex, DIM), base, X.DELTA)
    return base


def q_index_changes(spark, d):
    """Before and after images of what changed from version to version, over a compaction too."""
    base = _versioned_index(spark, d)
    out = None
    for after, until in ((1, 2), (2, 4), (1, 4)):
        part = X.read_changes(spark, base, after, until).select(F.lit(until).alias("until"), "change", *INDEX_COLUMNS)
        out = part if out is None else out.unionByName(part)
    return out


def q_index_as_of(spark, d):
    """The index as of its second version, after later ones were written."""
    return X.read_index(spark, _versioned_index(spark, d), version=2).select(*INDEX_COLUMNS)


def _sql_index_changes() -> str:
    new = _index_sql(_next_snapshot_cte().replace("songs_new AS", "songs AS", 1))
    cols = ", ".join("{0}." + c for c in INDEX_COLUMNS)
    differ = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in INDEX_COLUMNS)
    return f"""WITH old AS MATERIALIZED ({_index_sql(O.songs_cte())}), new AS MATERIALIZED ({new}),
changed AS (SELECT o, n, o.link IS NULL AS added, n.link IS NULL AS gone FROM old o FULL OUTER JOIN new n ON o.link = n.link WHERE {differ})
SELECT 2 AS until, CASE WHEN gone THEN 'delete' ELSE 'update_preimage' END AS change, {cols.format('o')} FROM changed WHERE NOT added
UNION ALL SELECT 2, CASE WHEN added THEN 'insert' ELSE 'update_postimage' END, {cols.format('n')} FROM changed WHERE NOT gone
UNION ALL SELECT 4, CASE WHEN added THEN 'delete' ELSE 'update_preimage' END, {cols.format('n')} FROM changed WHERE NOT gone
UNION ALL SELECT 4, CASE WHEN gone THEN 'insert' ELSE 'update_postimage' END, {cols.format('o')} FROM changed WHERE NOT added"""


QUERIES |= {"index_changes": q_index_changes, "index_as_of": q_index_as_of}
ORACLES |= {"index_changes": _sql_index_changes(), "index_as_of": ORACLES["index_upsert"]}


# ----------------------------------------------------------------------------- samples of a size, agreement

SAMPLE_ROWS, STRATUM_ROWS = 100, 20


def q_sample_exact(spark, d):
    """L4: exactly 100 songs."""
    return M.sample_exact(songs(spark, d), "link", SAMPLE_ROWS)


def q_sample_strata(spark, d):
    """L4: exactly 20 songs of every artist."""
    return M.sample_exact(songs(spark, d), "link", STRATUM_ROWS, stratum="artist")


def q_prompt_agreement(spark, d):
    """A5: agreement of the prompts' results beyond chance."""
    return P.prompt_agreement(P.prompt_grid(songs(spark, d), lexicon(spark, d)))


def _sql_sample(n: int, partition: str = "") -> str:
    return _with(O.songs_cte()) + f"""SELECT * FROM songs
QUALIFY row_number() OVER ({partition} ORDER BY {O.hex_int('link', 1, 15)}, link) <= {n}"""


def _sql_prompt_agreement() -> str:
    base = _sql_prompt_grid_base().rstrip()
    return f"""SELECT CAST(n_units AS BIGINT) AS n_units, CAST(n AS BIGINT) AS n_values, round(1 - o / n, 9) AS disagreement,
  round(1 - e / (n * (n - 1)), 9) AS expected, round(1 - (1 - o / n) / (1 - e / (n * (n - 1))), 9) AS alpha
FROM (WITH answers AS ({base} SELECT link, result FROM graded WHERE result IS NOT NULL),
cells AS (SELECT link, result, count(*) AS c FROM answers GROUP BY link, result),
units AS (SELECT link, sum(c) AS m FROM cells GROUP BY link HAVING sum(c) >= 2),
paired AS (SELECT * FROM cells JOIN units USING (link))
SELECT (SELECT count(*) FROM units) AS n_units, (SELECT sum(m) FROM units) AS n,
  (SELECT sum(c * (c - 1) / (m - 1)) FROM paired) AS o,
  (SELECT sum(t * (t - 1)) FROM (SELECT sum(c) AS t FROM paired GROUP BY result)) AS e)"""


QUERIES |= {"sample_exact": q_sample_exact, "sample_strata": q_sample_strata, "prompt_agreement": q_prompt_agreement}
ORACLES |= {"sample_exact": _sql_sample(SAMPLE_ROWS), "sample_strata": _sql_sample(STRATUM_ROWS, "PARTITION BY artist"),
            "prompt_agreement": _sql_prompt_agreement()}


# ----------------------------------------------------------------------------- plug-in models with kept answers

def flaky_labeler(inputs: list[str], attempt: int) -> list[str | None]:
    """Stands in for a hosted labeler: ten emotions from the text's length on. By the text's md5 one in
    sixteen fails at the first attempt and another one always."""
    import hashlib

    out = []
    for text in inputs:
        digit = hashlib.md5(text.encode()).hexdigest()[0]
        failed = digit == "f" or digit == "0" and attempt == 1
        out.append(None if failed else ", ".join(L.EMOTIONS[(len(text) + i) % len(L.EMOTIONS)] for i in range(10)))
    return out


def emotion_encoder(inputs: list[str], attempt: int) -> list[list[float]]:
    """Stands in for a hosted embedder: an entry per emotion, its place in the label (from 1), else 0."""
    return [[float(names.index(e) + 1) if e in names else 0.0 for e in L.EMOTIONS] for names in (s.split(", ") for s in inputs)]


def _plugin_labels(spark, d) -> DataFrame:
    from cadenza.operators import calls as C

    s = songs(spark, d)
    store = scratch_path(spark, "answers")
    C.ask(s, "text", flaky_labeler, store, name="flaky-1", attempts=1)       # one attempt: some fail
    answers = C.ask(s, "text", flaky_labeler, store, name="flaky-1", attempts=2, slices=2)
    return C.attach(s, "text", answers, "llm_labeled_emotions", name="flaky-1").drop("text")


def q_label_plugin(spark, d):
    """M1, 2.11: labels of a plug-in model that fails now and then; a second run asks what failed."""
    return _plugin_labels(spark, d)


def q_embed_plugin(spark, d):
    """M4, 2.11: vectors of a plug-in model; equal labels are asked once."""
    from cadenza.operators import calls as C

    labels = saved(_plugin_labels(spark, d).drop("error"), "labels")
    answers = C.ask(labels, "llm_labeled_emotions", emotion_encoder, scratch_path(spark, "vectors"), name="places-1", answer="array<float>")
    found = C.attach(labels, "llm_labeled_emotions", answers, "emotions_embeddings", name="places-1")
    return found.select("link", F.posexplode("emotions_embeddings").alias("pos", "value"))


def _plugin_ctes() -> str:
    n = len(L.EMOTIONS)
    names = "[" + ", ".join(O.q(e) for e in L.EMOTIONS) + "]"
    return _with(O.songs_cte()).rstrip() + f""", labeled AS (
SELECT artist, song, link, CASE WHEN substr(md5(text), 1, 1) <> 'f' THEN
         array_to_string(list_transform(range(10), lambda i: ({names})[(length(text) + i) % {n} + 1]), ', ') END AS llm_labeled_emotions,
       CASE WHEN substr(md5(text), 1, 1) = 'f' THEN 'no answer' END AS error FROM songs)
"""


QUERIES |= {"label_plugin": q_label_plugin, "embed_plugin": q_embed_plugin}
ORACLES |= {"label_plugin": _plugin_ctes() + "SELECT * FROM labeled",
            "embed_plugin": _plugin_ctes() + "SELECT link, CAST(e.pos AS INTEGER) AS pos, "
            "CAST(coalesce(list_position(string_split(llm_labeled_emotions, ', '), e.name), 0) AS FLOAT) AS value FROM labeled, "
            "(SELECT * FROM (VALUES " + ", ".join(f"({i}, {O.q(e)})" for i, e in enumerate(L.EMOTIONS)) + ")) e(pos, name) "
            "WHERE llm_labeled_emotions IS NOT NULL"}


# ----------------------------------------------------------------------------- the index as a data source

def q_index_source(spark, d):
    """The first snapshot's index and the delta of the second, written and read through
    the index's data source."""
    from cadenza.sources import index_source as I

    docs, lex, base = read_table(spark, d, "documents"), lexicon(spark, d), scratch_path(spark, "index-source")
    old, new = songs_from_documents(docs), fx.next_snapshot(docs)
    first = index_of(old, lex).select(*S.INDEX_COLUMNS)
    buckets = X.bucket_count(first.count(), DIM)
    I.write_index(first, base, X.BASE, buckets)
    diff = saved(X.snapshot_diff(old, new), "diff")
    I.write_index(saved(S.delta_of(S.changes_from_diff(new, diff, seq=1), lex, DIM), "delta"), base, X.DELTA, buckets)
    return I.open_index(spark, base, columns=",".join(INDEX_COLUMNS))


QUERIES |= {"index_source": q_index_source}
ORACLES |= {"index_source": ORACLES["index_upsert"]}


# ----------------------------------------------------------------------------- search from SQL text

def q_recommend_sql(spark, d):
    """M6, 2.11: ``recommend`` by the table function ``search_index`` in SQL text."""
    from cadenza.plans import search_sql as Q
    from cadenza.plans.recommend import query_vectors
    from cadenza.sources import index_source as I

    lex, base = lexicon(spark, d), scratch_path(spark, "index-sql")
    I.write_index(song_index(spark, d, lex).select(*S.INDEX_COLUMNS), base)
    return Q.recommend_sql(saved(query_vectors(sentences(spark, d), lex, DIM), "asked"), base, DIM, KNN)


QUERIES |= {"recommend_sql": q_recommend_sql}
ORACLES |= {"recommend_sql": ORACLES["recommend"]}


# ----------------------------------------------------------------------------- many phrases

def phrase_list(spark, d) -> DataFrame:
    """Every sequence of 2 or 3 words of the benchmark's texts."""
    words = read_table(spark, d, "benchmark").select(VF.tokens(F.col("text")).alias("w"))
    return PH.word_sequences(words, "w", (2, 3)).distinct()


def q_phrase_tag(spark, d):
    """M9: the phrases of the benchmark's texts in every song, by one automaton in one pass."""
    tagged = PH.phrase_tag(songs(spark, d), phrase_list(spark, d), "phrase")
    return tagged.select("link", F.size("phrases").alias("n_phrases"), F.array_join("phrases", "|").alias("phrases"))


def q_phrase_join(spark, d):
    """M9: the same beyond the automaton's byte budget, by a join on the songs' word sequences."""
    tagged = PH.phrase_tag(songs(spark, d), phrase_list(spark, d), "phrase", max_bytes=0)
    return tagged.select("link", F.size("phrases").alias("n_phrases"), F.array_join("phrases", "|").alias("phrases"))


def _sql_phrases() -> str:
    def grams(table: str, key: str) -> str:
        return " UNION ALL ".join(
            f"SELECT {key} unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS phrase FROM {table}"
            for n in (2, 3))
    return _with(O.songs_cte()) + f""", b AS (SELECT regexp_extract_all(lower(text), '[a-z]+') AS w FROM benchmark),
s AS (SELECT link, regexp_extract_all(lower(text), '[a-z]+') AS w FROM songs),
wanted AS (SELECT DISTINCT phrase FROM ({grams('b', '')})),
hits AS (SELECT DISTINCT link, phrase FROM ({grams('s', 'link,')}) JOIN wanted USING (phrase))
SELECT songs.link, CAST(count(phrase) AS INTEGER) AS n_phrases, coalesce(string_agg(phrase, '|' ORDER BY phrase), '') AS phrases
FROM songs LEFT JOIN hits ON hits.link = songs.link GROUP BY songs.link"""


QUERIES |= {"phrase_tag": q_phrase_tag, "phrase_join": q_phrase_join}
ORACLES |= {"phrase_tag": _sql_phrases(), "phrase_join": _sql_phrases()}
