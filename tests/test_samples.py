"""Samples of an exact size and agreement beyond chance, against plain versions."""

import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from cadenza.operators import measures as M
from cadenza.operators import prompts as P


def low(keys, n):
    return sorted(keys, key=lambda k: (hashlib.md5(k.encode()).hexdigest()[:15], k))[:n]


def test_sample_has_exactly_n_rows(spark):
    keys = [f"k{i}" for i in range(3000)]
    rows = [(k, None if i % 3 == 0 else "ab"[i % 2]) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "key string, s string").repartition(7)
    for n in (0, 1, 500, 3000, 5000):
        assert sorted(r.key for r in M.sample_exact(df, "key", n).collect()) == sorted(low(keys, n))
    got = M.sample_exact(df, "key", 40, stratum="s").collect()
    for s in (None, "a", "b"):
        assert sorted(r.key for r in got if r.s == s) == sorted(low([k for k, t in rows if t == s], 40))


def test_sample_of_repeated_and_null_keys(spark):
    df = spark.range(90).select(F.when(F.col("id") % 2 == 0, F.lit("same")).alias("key"), F.col("id"))
    twice = df.unionByName(df)
    for n in (1, 50, 179, 180, 181):
        got = [tuple(r) for r in M.sample_exact(twice, "key", n).collect()]
        assert len(got) == min(n, 180) and max(Counter(got).values()) <= 2
    assert M.sample_exact(df.where("false"), "key", 5).count() == 0


def alpha(units):
    units = [[v for v in u if v is not None] for u in units]
    units = [u for u in units if len(u) > 1]
    n = sum(map(len, units))
    apart = sum(sum(a != b for i, a in enumerate(u) for j, b in enumerate(u) if i != j) / (len(u) - 1) for u in units) / n
    flat = [v for u in units for v in u]
    chance = sum(a != b for i, a in enumerate(flat) for j, b in enumerate(flat) if i != j) / (n * (n - 1))
    return len(units), n, apart, chance, 1 - apart / chance


def test_agreement_equals_the_definition(spark):
    rnd = random.Random(3)
    units = [[rnd.choice(["x", "x", "y", "z", None]) for _ in range(rnd.randint(1, 5))] for _ in range(60)]
    grid = spark.createDataFrame([(str(i), v) for i, u in enumerate(units) for v in u], "link string, result string")
    got = P.prompt_agreement(grid).first()
    want = alpha(units)
    assert tuple(got[:2]) == want[:2]
    assert all(abs(a - b) < 1e-8 for a, b in zip(got[2:], want[2:]))


def test_agreement_without_disagreement_or_answers(spark):
    alike = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("b", "x")], "link string, result string")
    assert tuple(P.prompt_agreement(alike).first()) == (2, 4, 0.0, 0.0, None)
    assert tuple(P.prompt_agreement(alike.where("false")).first()) == (0, 0, None, None, None)
