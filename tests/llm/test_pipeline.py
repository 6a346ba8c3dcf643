"""The pipeline against plain versions of its stages, each judged on its own input."""

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from test_jaccard import brute as jaccard_brute
from test_lines import brute as lines_brute
from test_mix import brute_targets
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from cadenza.llm.common import documents, written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs = [documents(spark, SF)]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(written(stage(spark, docs[-1], SF), name))
    return [d.collect() for d in docs]


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard_join", "source_mix", "packing"]


def test_columns_stay(outputs):
    assert all(r.asDict().keys() == outputs[0][0].asDict().keys() for rows in outputs[:-1] for r in rows[:1])


def test_language_id_rejects_only_texts_without_one(outputs):
    kept = {r["doc_id"] for r in outputs[1]}
    lettered = {r["doc_id"] for r in outputs[0] if re.search(r"[^\W\d_]", r["text"] or "")}
    assert kept <= lettered and len(kept) >= 0.99 * len(lettered)


def test_line_dedup(outputs):
    want = lines_brute([(r["doc_id"], r["text"]) for r in outputs[1]])
    got = {r["doc_id"]: r for r in outputs[2]}
    before = {r["doc_id"]: r["text"] for r in outputs[1]}
    assert got.keys() == {d for d, t in want.items() if t.strip(" \t\n\x0b\x0c\r") or t == before[d]}
    assert all(r["text"] == want[d] and r["n_chars"] == len(want[d]) for d, r in got.items())


def test_one_of_each_near_copy(outputs):
    want = jaccard_brute([(r["doc_id"], r["text"]) for r in outputs[2]], 5, 80)
    assert sorted(r["doc_id"] for r in outputs[3]) == sorted({c for _, c in want.values()})


def test_mix(outputs):
    def sizes(rows):
        out = {}
        for r in rows:
            out[r["source"]] = out.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
        return out

    before, after = sizes(outputs[3]), sizes(outputs[4])
    for s, target in brute_targets(before).items():
        assert abs(after.get(s, 0) - target) <= max(0.1 * target, 60), s


def test_packing(outputs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = sum(len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in outputs[4])
    assert sum(p["length"] for p in outputs[5]) == total
    for p in outputs[5]:
        ids = np.array(p["ids"], "<u4")
        assert len(ids) == p["length"] and zlib.crc32(ids.tobytes()) == p["ids_crc32"]


def test_registered(spark):
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert sorted({int(m[1]) for x in names if (m := re.match(r"op(\d+)_", x))}) == list(range(1, 14))
    assert corpus_pipeline.run(spark, SF).count() > 0
