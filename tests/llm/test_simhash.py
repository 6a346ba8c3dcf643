import hashlib
import random
import re

import pytest
import xxhash

from cadenza.llm import simhash


def fingerprint(text):
    w, votes = [x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", text)], [0] * 64
    for i in range(len(w)):
        h = xxhash.xxh64_intdigest(w[i], 42)
        if i + 1 < len(w):
            h = xxhash.xxh64_intdigest(w[i + 1], h)
        for b in range(64):
            votes[b] += 1 if h >> b & 1 else -1
    return sum(1 << b for b in range(64) if votes[b] > 0)


def bits(a, b):
    return (a ^ b).bit_count()


@pytest.mark.parametrize("range_rows", [7, 1000])
def test_against_brute_force(spark, monkeypatch, range_rows):
    monkeypatch.setattr(simhash, "RANGE_ROWS", range_rows)
    rng = random.Random(8)
    docs = [(rng.choice([i, i * 1000]), " ".join(rng.choice(["é", "word", "\U0001f600x", "other"]) for _ in range(rng.choice([0, 1, 2, 9, 40]))))
            for i in range(1, 90)]
    docs = list({d: (d, t) for d, t in docs}.values()) + [(-4, None), (50, "é word"), (100, "é word"), (150, "é word other")]
    docs = sorted({d: t or "" for d, t in docs}.items())
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    fps = {d: fingerprint(t) for d, t in docs}
    got = {r["doc_id"]: r for r in simhash.fingerprint_table(df).collect()}
    assert len(got) == len(docs)
    for k, (d, text) in enumerate(docs):
        after, following = docs[(k + 1) % len(docs)]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        near = sum(bits(fps[d], fps[q]) <= 3 for q in fps if q % 50 == 0 and q != d)
        assert tuple(got[d]) == (
            d, len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{fps[d]:016x}", f"{fingerprint(edited):016x}",
            1 - bits(fps[d], fingerprint(edited)) / 64, 1 - bits(fps[d], fps[after]) / 64, near)


def test_all_pairs_within_the_radius(spark):
    rng = random.Random(9)
    fps = [rng.getrandbits(64) for _ in range(60)]
    fps += [f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for f in fps for _ in range(3)]
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(set(fps))]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    for radius, blocks in ((3, 5), (2, 4)):
        got = {tuple(r) for r in simhash.within_radius(df, df, radius, blocks).collect()}
        mask = (1 << 64) - 1
        assert got == {(a, b) for a in signed for b in signed if bits(a & mask, b & mask) <= radius}


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "x y"), (None, "a"), (1, "b c"), (1, "b c")], "doc_id bigint, text string")
    got = simhash.fingerprint_table(df).collect()
    assert len(got) == 4 and len({r["fingerprint"] for r in got if r["doc_id"] == 1}) == 1


def test_no_python_in_the_plan(spark):
    df = simhash.fingerprint_table(spark.createDataFrame([(1, "x y")], "doc_id bigint, text string"))
    assert "Python" not in df._jdf.queryExecution().toString()
