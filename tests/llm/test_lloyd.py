import hashlib
import math
import random

import numpy as np
import pytest

from cadenza.llm import lloyd

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k, rounds, dims):
    kept = [(i, [math.floor(256.0 * x) for x in v]) for i, v, _ in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def assign():
        out = []
        for i, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((i, far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        got = assign()
        for j in range(len(centroids)):
            own = [v for (_, v), (_, c, _) in zip(kept, got) if c == j]
            if own:
                centroids[j] = [sum(col) // len(own) for col in zip(*own)]
    got = assign()
    by = {j: sum(d for _, c, d in got if c == j) for j in range(len(centroids))}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, by[c], sum(by.values()), names[c]) for i, c, d in got), key=str)


def rows_of(seed, n, dims):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1, 0, 1]) * rng.random() + (i % 5) for _ in range(dims)], 0) for i in range(n)]
    rows += [(900 + i, [0.5] * dims, 1) for i in range(20)] + rows[3:4] * 4           # ties and repeats
    rows += [(1000, None, 1), (1001, [1.0] * (dims - 1), 1), (1002, [float("nan")] * dims, 1), (None, [2.0] * dims, None),
             (1003, [None] * dims, 1), (1004, [float("inf")] + [0.0] * (dims - 1), 1), (3, [-1.25] * dims, 1)]
    return rows


@pytest.mark.parametrize("blocks,k", [(1, 7), (3, 7), (8, 500)])
def test_brute_force(spark, monkeypatch, blocks, k):
    monkeypatch.setattr(lloyd, "VECTOR_BLOCK", 16)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], n)
            for i, v, n in rows_of(blocks, 120, 8)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'mine' AS cluster", "1 AS part").repartition(3)
    got = sorted((tuple(r) for r in lloyd.lloyd(df, k=k, rounds=3, dims=8, blocks=blocks).collect()), key=str)
    assert got == brute(rows, k, 3, 8)


def test_empty_and_odd(spark):
    df = spark.createDataFrame(rows_of(1, 0, 8)[-7:], SCHEMA)
    assert lloyd.lloyd(df.where("false"), dims=8).collect() == []
    assert {r["vec_id"] for r in lloyd.lloyd(df, dims=8).collect()} == {None, 3}
