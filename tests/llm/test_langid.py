import numpy as np
import pytest

from cadenza.llm import langid
from cadenza.llm.common import documents


def viterbi(s, penalty):
    v, back = s[0].copy(), []
    for t in range(1, len(s)):
        m = v.argmax()
        back.append(np.where(v >= v[m] - penalty, np.arange(len(v)), m))
        v = s[t] + np.maximum(v, v[m] - penalty)
    path = [int(v.argmax())]
    for b in back[::-1]:
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_best_path():
    rng = np.random.RandomState(0)
    for _ in range(20):
        counts = rng.randint(0, 130, 15)
        s, at = rng.randn(counts.sum(), 4) * 3, 0
        got = langid.best_languages(s, counts, 5.0)
        for n in counts:
            if n:
                assert got[at:at + n].tolist() == viterbi(s[at:at + n], 5.0)
            at += n


def test_held_out_accuracy(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    got = langid.language_table(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 100
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


@pytest.fixture(scope="module")
def model(spark):
    return langid.LanguageModel.fit(documents(spark, "/root/testdata/sf0.01"))


def test_spans_of_mixed_text(spark, model):
    by = {r["lang"]: r["text"].split()[:60] for r in documents(spark, "/root/testdata/sf0.01").where("length(text) > 600").collect()}
    text = " ".join(by["de"] + by["es"])
    row = langid.label_languages(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), model).first()
    assert [s["lang"] for s in row["spans"]] == ["de", "es"]
    assert abs(row["spans"][0]["end"] - 60) <= 2 and row["spans"][1]["end"] == 120
    assert row["score"] < 0.7


def test_scripts_narrow_the_candidates(spark):
    rows = [(i, t, x) for i in range(9) for t, x in (("привет мир", "ru"), ("hello world", "en"))]
    model = langid.LanguageModel.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    docs = spark.createDataFrame([(1, "вода"), (2, "water"), (3, "水")], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.label_languages(docs, model).collect()}
    assert got[1][0] == "ru" and got[2][0] == "en" and got[3][1] <= 0.5


def test_nothing_learned(spark):
    model = langid.LanguageModel.fit(spark.createDataFrame([], "doc_id bigint, text string, lang string"))
    row = langid.label_languages(spark.createDataFrame([(1, "some text")], "doc_id bigint, text string"), model).first()
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)
