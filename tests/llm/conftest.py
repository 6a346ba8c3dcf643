import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows):
    return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and extra
    columns whose names the operators use themselves."""
    long_text = " ".join(f"word{i % 977} and{i % 31}" for i in range(60_000))
    rows = [
        (1, "the same words in the same order here", "en", "a"), (1, "the same words in the same order here", "en", "a"),
        (2, "the same words in the same order here", "en", "b"), (3, None, "en", "b"), (4, "", None, None),
        (5, " \n\t \n", "en", None), (None, "a text without an id but with words", None, "a"),
        (None, None, None, None), (6, long_text, "en", "a"), (7, "\U0001f600 \U0001f600\n123 456", "de", "c"),
        (8, "la casa de la montaña es muy grande", "es", "c"), (50, "one", None, "a"),
    ]
    df = frame(spark, rows)
    for name in ("size", "target", "copies", "score", "kept", "lang_pred", "spans", "sig", "node", "key", "n", "h"):
        df = df.withColumn(name, F.lit("mine"))
    return df


@pytest.fixture(scope="session")
def empty_docs(edge_docs):
    return edge_docs.where("false")


def words(rng: random.Random, n: int, size: int = 400) -> list[str]:
    return [f"w{rng.randrange(size)}" for _ in range(n)]


@pytest.fixture(scope="session")
def near_copies():
    """(doc_id, text): unrelated texts, exact copies, and copies with a few words changed."""
    rng = random.Random(5)
    out = []
    for i in range(60):
        base = words(rng, rng.choice([1, 3, 4, 7, 12, 20, 45, 60, 150]))
        out.append(base)
        for _ in range(rng.choice([0, 1, 3])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9)}"
            out.append(copy)
    rng.shuffle(out)
    return [(i, " ".join(w)) for i, w in enumerate(out)]
