"""Rows are known by id and text: other texts under one id, null ids, and rows that repeat."""

from cadenza.llm import jaccard, lines, stages

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = [f"w{i}" for i in range(120)]


def text(at=None):
    words = list(LONG)
    if at is not None:
        words[at] = "other"
    return " ".join(words)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], SCHEMA)


def test_other_texts_under_one_id_stay(spark):
    rows = [(5, text()), (5, text()), (5, "an unrelated text of some more words that nobody has copied at all"), (3, text(60))]
    for order in (rows, rows[::-1]):
        got = stages.ngram_jaccard_join(spark, frame(spark, order), "").collect()
        assert sorted((r["doc_id"], r["text"]) for r in got) == sorted([rows[2], rows[3]])


def test_copies_without_an_id_leave_one(spark):
    rows = [(None, text()), (None, text()), (None, text(60))]
    assert stages.ngram_jaccard_join(spark, frame(spark, rows), "").count() == 1
    same = [(9, text())] * 4
    assert [(r["doc_id"], r["text"]) for r in stages.ngram_jaccard_join(spark, frame(spark, same), "").collect()] == same[:1]


def test_links_of_null_ids(spark):
    got = jaccard.jaccard_components(frame(spark, [(None, text()), (None, text(40)), (7, text(80))]), 4, 85).collect()
    assert [r["component_id"] for r in got] == [7, 7, 7]


def test_lines_go_from_their_own_row_only(spark):
    copied = "a line of more than five words that stands in two places"
    rows = [(1, "first line that is only here and has words\nunique line number one of this very text"),
            (1, f"something else altogether in the first line\n{copied}"), (0, copied)]
    got = {(r["doc_id"], r["text"]) for r in lines.line_dedup(frame(spark, rows)).collect()}
    assert got == {rows[0], (1, "something else altogether in the first line"), rows[2]}
