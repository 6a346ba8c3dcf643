import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cadenza.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_words_give_the_ids_of_the_text(tokenizer, monkeypatch):
    own = packing.WordTokenizer(open(PATH, encoding="utf-8").read())
    assert own.kind == np.dtype("<u2")
    monkeypatch.setattr(packing, "STRETCH", 500)
    monkeypatch.setattr(packing, "CACHE_WORDS", 300)
    rng = random.Random(1)
    alphabet = "abcXYZéÉßµİΣσ́  \n\t.,'\"!#0123_-\U0001f600水\x1c\x85"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["don't we'll", "<|endoftext|> x", "Å ﬁ", None]
    for text, ids in zip(texts, own.encode(pa.array(texts))):
        assert np.frombuffer(ids, own.kind).tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids + [1], repr(text)


@pytest.mark.parametrize("with_ids", [False, True])
def test_round_trip(spark, tokenizer, with_ids):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(["alpha", "Beta,", "gamma", "delta!"]) for _ in range(rng.choice([0, 3, 200, 2000, 9000]))),
             rng.choice(["a", "a", "b", None])) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string").repartition(5)
    pieces = packing.pack(df, PATH, with_ids=with_ids).collect()
    ids = {d: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [1], "<u4") for d, t, _ in docs}
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_seq.setdefault(p["sequence_id"], []).append(p)
    assert by_doc.keys() == ids.keys()
    for d, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            part = ids[d][at:at + p["length"]]
            assert p["start"] == at and zlib.crc32(part.tobytes()) == p["ids_crc32"] and p["doc_tokens"] == len(ids[d])
            assert not with_ids or p["ids"] == part.tolist()
            at += p["length"]
        assert at == len(ids[d])
    lengths = []
    for own in by_seq.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        lengths.append(at)
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths) and max(lengths) == 2048
    assert sum(n < 2048 for n in lengths) <= 11


def test_windows_follow_the_shares():
    pack = packing.Packer({"a": 0.7, "b": 0.3}, 0)
    for i in range(4000):
        pack.add("ab"[i % 2], i, bytes(4 * 300), 0, 300)
    for window in range(5):
        pack.out = []
        pack.fill(packing.WINDOW * packing.SEQUENCE)
        own = sum(len(r[2]) // 4 for r in pack.out if r[0] % 2 == 0)
        assert abs(own / (packing.WINDOW * packing.SEQUENCE) - 0.7) < 0.01
    assert all(abs(d) <= 600 for d in pack.deficit.values())


def test_windows_follow_the_shares_of_clustered_input(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASK_BYTES", 2 << 20, raising=False)      # several tasks
    docs = [(i, "alpha " * 300, "abc"[(i >= 3000) + (i >= 4500)]) for i in range(6000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string").repartitionByRange(4, "doc_id")
    df = df.sortWithinPartitions("source", "doc_id")
    windows = {}
    for p in packing.pack(df, PATH).collect():
        if p["sequence_id"] >> 32 < 1 << 30:        # first round
            task, nth = p["sequence_id"] >> 32, p["sequence_id"] & 0xFFFFFFFF
            own = windows.setdefault((task, nth // packing.WINDOW), {})
            source = docs[p["doc_id"]][2]
            own[source] = own.get(source, 0) + p["length"]
    size = packing.WINDOW * packing.SEQUENCE
    full = [w for w in windows.values() if sum(w.values()) == size]
    assert len({task for task, _ in windows}) > 1 and len(full) >= 20
    for own in full:
        for source, share in zip("abc", (0.5, 0.25, 0.25)):
            assert abs(own.get(source, 0) / size - share) < 0.1, own
