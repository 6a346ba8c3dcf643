"""Plug-in models: a pandas UDF labeler and an iterator pandas UDF embedder in the same plans."""

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

from cadenza.operators.embed import udf_embedder
from cadenza.operators.index import build_index
from cadenza.operators.label import EMOTIONS, udf_labeler
from cadenza.plans.recommend import recommend, song_vectors
from cadenza.sources.tables import sentences, songs
from conftest import SF_SMALL

DIM = 16

# user code that runs in tasks must reach the workers: ship this module by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def fake_model(texts: pd.Series) -> pd.Series:
    """Stands in for a hosted model: a Python-array answer, chosen from the text length."""
    def answer(t):
        if t is None:
            return "Sorry, I cannot help with that."
        n = len(t)
        return "Array: [" + ", ".join(EMOTIONS[(n + i) % len(EMOTIONS)] for i in range(10)) + "]"
    return texts.map(answer)


def fake_encoder(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    weights = np.random.default_rng(0).normal(size=(len(EMOTIONS), DIM))  # "loaded once"
    index = {e: i for i, e in enumerate(EMOTIONS)}
    for labels in batches:
        out = []
        for s in labels:
            v = np.zeros(DIM)
            for w in (s or "").replace("ERROR:", "").split(","):
                if w.strip() in index:
                    v += weights[index[w.strip()]]
            out.append(v.astype(np.float32))
        yield pd.Series(out)


def test_plugins_flow_through_recommend(spark):
    model = F.pandas_udf(fake_model, "string").asNondeterministic()
    encoder = F.pandas_udf(fake_encoder, "array<float>")
    labeler = udf_labeler(model)
    embedder = udf_embedder(encoder)
    vecs = song_vectors(songs(spark, SF_SMALL), labeler=labeler, embedder=embedder)
    index = build_index(vecs, dim=DIM)
    lab = vecs.select("llm_labeled_emotions").collect()
    assert all(r[0] is None or r[0].startswith("ERROR") or len(r[0].split(", ")) == 10 for r in lab)
    res = recommend(sentences(spark, SF_SMALL), index, dim=DIM, labeler=labeler, embedder=embedder)
    rows = res.collect()
    assert rows and max(r["rank"] for r in rows) == 10
    assert all(-1.0 - 1e-9 <= r.score <= 1.0 + 1e-9 for r in rows)
