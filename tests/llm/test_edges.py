"""Every operator on awkward rows and on an empty table: no crash, and the stated result."""

import public_tokenizers
import pytest

from cadenza.llm import (htmltext, jaccard, langid, lines, mix, packing, pii, quality, simhash, stages, toxicity)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LABELS = "doc_id bigint, quality int, toxic int"
TABLES = {
    "op2": mix.mix_table, "op3": pii.pii_table, "op4": langid.language_table, "op6": simhash.fingerprint_table,
    "op7": lambda d: packing.pack(d, TOKENIZER), "op9": lines.line_dedup, "op10": jaccard.jaccard_components,
}


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (None, 0, 1), (3, None, None), (8, 0, 1), (8, 1, 0)], LABELS)


@pytest.mark.parametrize("name", list(TABLES))
def test_empty(empty_docs, name):
    assert TABLES[name](empty_docs).collect() == []


def test_empty_with_labels(spark, empty_docs):
    assert quality.quality_table(empty_docs, labels(spark)).collect() == []
    assert toxicity.toxicity_table(empty_docs, labels(spark)).collect() == []


@pytest.mark.parametrize("name", ["op2", "op3", "op4", "op6", "op9", "op10"])
def test_a_row_each(edge_docs, name):
    assert TABLES[name](edge_docs).count() == edge_docs.count()


def test_mix_takes_nothing_of_empty_texts(edge_docs):
    got = mix.mix_table(edge_docs).collect()
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)


def test_labelled(spark, edge_docs):
    q = {(r["doc_id"], r["n_words"]): r for r in quality.quality_table(edge_docs, labels(spark)).collect()}
    assert q[3, 0]["base_failed"] and not q[3, 0]["kept"]
    assert toxicity.toxicity_table(edge_docs, labels(spark)).count() == edge_docs.count()


def test_language_of_nothing(edge_docs):
    got = [r for r in langid.language_table(edge_docs).collect() if r["doc_id"] in (3, 4, 5)]
    assert {r["lang_pred"] for r in got} == {"und"} and {r["score"] for r in got} == {0.0}
    assert all(not r["held_out"] for r in langid.language_table(edge_docs).collect() if r["doc_id"] is None)


def test_components_of_repeats(edge_docs):
    got = jaccard.jaccard_components(edge_docs, 4, 85).collect()
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2)} == {1}
    assert {(r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] == 4} == {(0, 4)}


def test_pieces_of_every_row(edge_docs):
    got = packing.pack(edge_docs, TOKENIZER).collect()
    whole = sum(r["length"] for r in got)
    starts = [r for r in got if r["start"] == 0]
    assert len(starts) == edge_docs.count() and sum(r["doc_tokens"] for r in starts) == whole


def test_lines_keep_columns(edge_docs):
    got = lines.line_dedup(edge_docs)
    assert set(edge_docs.columns) <= set(got.columns)
    rows = {r["doc_id"]: r for r in got.where("doc_id IN (2, 3, 4, 7)").collect()}
    assert rows[2]["text"] == "" and rows[2]["n_removed"] == 1
    assert rows[3]["text"] is None and rows[4]["text"] == "" and rows[7]["n_removed"] == 0


@pytest.mark.parametrize("stage", [stages.language_id, stages.line_dedup, stages.ngram_jaccard_join, stages.source_mix])
def test_stages_keep_columns(spark, edge_docs, empty_docs, stage):
    assert stage(spark, edge_docs, "").columns == edge_docs.columns
    assert stage(spark, empty_docs, "").count() == 0


def test_pages(spark):
    rows = [(1, None, None), (1, None, None), (2, "not a url", "<p>x"), (None, "http://h/a", ""),
            (3, "http://h/b", "<p>" + "y " * 100_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'mine' AS lines", "1 AS uid")
    got = htmltext.main_text(pages).collect()
    assert len(got) == 5 and sorted(r["n_chars"] for r in got) == [0, 0, 0, 1, 199_999]
    assert htmltext.main_text(pages.where("false")).collect() == []
