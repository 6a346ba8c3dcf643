import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cadenza.llm import phrases

SCHEMA = "doc_id bigint, text string, lang string, source string"


def brute(rows, depth, least, top, within):
    grams, size = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            size[lang] += len(w)
            for d in range(1, depth + 1):
                grams[lang].update(tuple(w[i:i + d]) for i in range(len(w) - d + 1))
    out = []
    for lang, f in grams.items():
        cand, rows = {p: a for p, a in f.items() if len(p) > 1 and a >= least}, []
        for p, a in cand.items():
            if any(100 * b >= within * a for q, b in cand.items()
                   if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, text, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, text.decode(), -a, l, r, size[lang], -score))
    return sorted(out)


def texts(seed, n):
    rng = random.Random(seed)
    vocab = ["The", "the", "cat", "dog,", "élan", "É.", "a\x1cb", " x", "zz", "New", "york", "city", "of", "of", "of"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 60)):
            words += ["new", "york", "city"] if rng.random() < 0.1 else ["of", "the"] if rng.random() < 0.2 else [rng.choice(vocab)]
        rows.append((i % 50, rng.choice([" ", " ", "\t", "  "]).join(words) + rng.choice(["", "\n", "!"]), rng.choice(["en", "en", "fr", None]), "a"))
    return rows + [(1, None, "en", "a"), (2, "", "de", None), (3, " ,\n. ", None, "a"), (None, "of the of the", "en", "b")] + rows[:3]


@pytest.mark.parametrize("depth,hot,cut", [(3, 20_000, 4 << 20), (3, 30, 64), (2, 30, 300), (4, 60, 200)])
def test_brute_force(spark, monkeypatch, depth, hot, cut):
    """Also with many hot pairs, many buckets, and texts cut into short parts."""
    monkeypatch.setattr(phrases, "HOT_PARTS", hot)
    monkeypatch.setattr(phrases, "SLICE_BYTES", cut)
    monkeypatch.setattr(phrases, "BUCKET_POINTERS", 700)
    rows = texts(depth + hot, 250)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'mine' AS phrase", "1 AS n", "2 AS f").repartition(3)
    got = sorted(tuple(r) for r in phrases.collocations(df, depth, 5, 40, 50).collect())
    assert got == brute(rows, depth, 5, 40, 50)


def test_partitions_are_counts():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 6, (4000, 3)).astype(np.int32)
    ids[rng.random(4000) < 0.2, 2] = -1
    ids[rng.random(4000) < 0.1, 1:] = -1
    weight = rng.integers(1, 4, 4000)
    want = Counter()
    for row, w in zip(ids.tolist(), weight.tolist()):
        for d in range(1, 4):
            if row[d - 1] >= 0:
                want[tuple(row[:d])] += w
    got = {tuple(ids[i, :d].tolist()): f for p, c, d in phrases.multikey_sort(ids, weight, 30) for i, f in zip(p.tolist(), c.tolist())}
    assert got == {p: f for p, f in want.items() if f >= 30}
    assert list(phrases.multikey_sort(ids[:0], weight[:0], 1)) == []


def test_empty_and_awkward(edge_docs, empty_docs):
    assert phrases.collocations(empty_docs).collect() == []
    got = phrases.collocations(edge_docs, 3, 2, 2000, 50).collect()
    assert {r["lang"] for r in got} <= {"en", "und"} and any(r["phrase"] == "the same words" for r in got)
