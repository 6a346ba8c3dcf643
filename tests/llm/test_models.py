"""Toxicity (ordinal regression) and quality rules (boosted trees)."""

import re
from collections import Counter

import numpy as np
import pytest

from cadenza.llm import quality, toxicity
from cadenza.llm.common import documents, table

SF = "/root/testdata/sf0.01"


def test_ordinal_fit_orders_grades():
    rng = np.random.RandomState(1)
    x = rng.randint(0, 3, (3000, 4)).astype(float)
    eta = x @ np.array([1.5, -1.0, 0.5, 0.0]) + rng.logistic(size=3000)
    grade = np.digitize(eta, [1.0, 2.5, 4.0])
    row, feature = np.nonzero(x)
    w, cuts = toxicity.fit_ordinal(row, feature, x[row, feature], grade, 4)
    assert np.allclose(w, [1.5, -1.0, 0.5, 0.0], atol=0.25) and np.allclose(cuts, [1.0, 2.5, 4.0], atol=0.35)
    assert (np.diff(cuts) > 0).all()


def test_toxic_words_are_found(spark):
    rows = [(i, f"plain text number {i} with words", 0) for i in range(60)]
    rows += [(100 + i, f"plain text number {i} with " + " ".join(["vileword"] * (1 + i % 6)), 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity_table(docs, docs.select("doc_id", "toxic")).collect()}
    assert all(got[i]["toxic"] == (t > 0) for i, _, t in rows)
    assert got[105]["severity"] > got[100]["severity"] > got[0]["severity"] and got[105]["grade"] > got[100]["grade"] >= 1


def test_held_out_toxicity(spark):
    docs, labels = documents(spark, "/root/testdata/sf0.1"), table(spark, "/root/testdata/sf0.1", "labels")
    train = labels.where("doc_id % 4 <> 2")
    got = toxicity.toxicity_table(docs, train).join(labels.where("doc_id % 4 = 2").select(
        "doc_id", labels["toxic"].alias("truth")), "doc_id").collect()
    clean, toxic = ([r["toxic"] for r in got if r["truth"] == t] for t in (0, 1))
    assert np.mean(clean) < 0.01 and np.mean(toxic) > 0.7       # some labelled rows hold no toxic word


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, windows, mark, dup = set(), Counter(zip(w, w[1:], w[2:])), [0] * len(w), 0
    for i in range(len(w) - 2):
        if windows[w[i], w[i + 1], w[i + 2]] > 1:
            mark[i] = mark[i + 1] = mark[i + 2] = 1
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return (len(w), sum(map(len, w)), symbols, dup, sum(mark), len(w) < 50 or 100 * sum(mark) > 50 * len(w))


def test_base_counts(spark):
    docs = documents(spark, SF)
    extra = [(-1, None), (-2, "a\n a\na\n\n\nb a\na"), (-3, "é#é | \x0b\x0cx\x85y ﬁ"), (-4, "a b a b a b a"), (-5, "\n")]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id bigint, text string"))
    texts = dict(docs.collect())
    got = quality.quality_table(docs, table(spark, SF, "labels")).collect()
    assert len(got) == len(texts)
    for r in got:
        assert brute(texts[r[0]]) == tuple(r)[1:7]
        assert not (r["base_failed"] and r["kept"])


def test_verdict_follows_the_labels(spark):
    got = quality.quality_table(documents(spark, SF), table(spark, SF, "labels")).join(
        table(spark, SF, "labels"), "doc_id").where("NOT base_failed").collect()
    assert np.mean([r["kept"] for r in got if r["quality"] == 1]) > 0.99
    assert np.mean([r["kept"] for r in got if r["quality"] == 0]) < 0.1


@pytest.mark.parametrize("sign", [1, -1])
def test_monotonic_constraint(sign):
    rng = np.random.RandomState(3)
    x = rng.rand(4000, 3)
    y = (np.sin(9 * x[:, 0]) * sign + x[:, 1] + 0.3 * rng.randn(4000) > 0.5).astype(float)
    forest = quality.fit_forest(x, y, [sign, 0, 0])
    line = np.linspace(0, 1, 200)
    for a, b in rng.rand(20, 2):
        score = forest.raw(np.column_stack([line, np.full(200, a), np.full(200, b)]))
        assert (sign * np.diff(score) >= -1e-9).all()
    free = quality.fit_forest(x, y, [0, 0, 0])
    assert ((free.score(x) > 0.5) == y).mean() > ((forest.score(x) > 0.5) == y).mean() > 0.6
