import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cadenza.llm import repeats, suffixes

SCHEMA = "doc_id bigint, text string, source string"


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t, _ in rows]
    seen = Counter(t[p:p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                gone[p + 1:p + 1 + length] = True
        kept = bytes(b for b, g in zip(t, gone[1:]) if not g)
        out.append((i, len(t), len(t) - len(kept), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(seed):
    rng = random.Random(seed)

    def words(n):
        return " ".join(rng.choice(["alpha", "bé", "the", "of", "gamma", "\U0001f600x", "delta"]) + rng.choice(["", str(rng.randrange(50))]) for _ in range(n))

    shared = [words(60) for _ in range(4)]
    rows = []
    for i in range(90):
        t = words(rng.choice([0, 5, 40, 200]))
        for _ in range(rng.choice([0, 0, 1, 2])):
            t += rng.choice(shared)[rng.randrange(40):] + words(rng.randrange(6))
        rows.append((i % 80, t, "a"))
    rows += [(100, "#" * 700, None), (101, "#" * 205, "b"), (102, "ab" * 300, "b"), (103, "x" * 5000, "c"), (104, None, None),
             (105, "", "a"), (None, "z" * 150, "a"), (None, shared[0], "a"), (106, shared[1] * 3, "a")]
    return rows + rows[5:9] * 2 + rows[-2:]


@pytest.mark.parametrize("length,segment,shard,region", [(200, 256 << 10, 24 << 20, 1024), (40, 100, 3000, 30), (9, 64, 500, 7)])
def test_brute_force(spark, monkeypatch, length, segment, shard, region):
    """Also with many shards, long texts cut into parts, and regions cut short."""
    for name, value in (("SEGMENT", segment), ("SHARD_BYTES", shard), ("REGION", region), ("HELD", 20)):
        monkeypatch.setattr(repeats, name, value)
    rows = texts(length)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'mine' AS key", "1 AS n", "2 AS times").repartition(3)
    got = sorted((tuple(r) for r in repeats.repeated_spans(df, length).collect()), key=str)
    assert got == brute(rows, length)


def test_empty_and_awkward(edge_docs, empty_docs):
    assert repeats.repeated_spans(empty_docs).collect() == []
    got = repeats.repeated_spans(edge_docs).collect()
    assert len(got) == edge_docs.count() and {r["n_removed"] for r in got if r["n_bytes"] < 200} == {0}


@pytest.mark.parametrize("seed", range(6))
def test_suffixes(monkeypatch, seed):
    """Order and common prefixes against sorting, with tiny blocks and with queues on disk."""
    rng = random.Random(seed)
    for _ in range(150):
        monkeypatch.setattr(suffixes, "BLOCK", rng.choice([1, 3, 17, 1 << 18]))
        monkeypatch.setattr(suffixes, "MEMORY", rng.choice([0, 1 << 20]))
        monkeypatch.setattr(suffixes, "BASE", rng.choice([0, 300_000]), raising=False)
        t = [rng.randrange(rng.choice([1, 2, 3, 250])) for _ in range(rng.choice([0, 1, 2, 9, 60, 200]))]
        t = bytes(t[:len(t) // 3] * 2 + [255] + t) if rng.random() < 0.5 else bytes(t)
        cap = rng.choice([3, 20, 200, 300])
        order, shared = suffixes.suffixes(np.frombuffer(t, np.uint8), cap)
        want = sorted(range(len(t)), key=lambda i: t[i:])
        assert order.tolist() == want
        for a, b, k in zip(want, want[1:], shared.tolist()[1:]):
            n = next((i for i, (x, y) in enumerate(zip(t[a:], t[b:])) if x != y), len(t) - max(a, b))
            assert k == min(n, cap)
