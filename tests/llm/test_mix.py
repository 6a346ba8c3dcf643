import random

import pytest

from cadenza.llm import mix


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Deal by weight, stop at the caps, deal the excess anew, until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if level * w[s] >= most * sizes[s]}
        if not full:
            target.update({s: level * w[s] for s in free})
            break
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= full
    return target


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    rows, doc = [], 0
    for source, n in (("a", 300), ("b", 40), ("é", 120), ("c", 2500), (None, 60), ("empty", 3)):
        for _ in range(n):
            size = 0 if source == "empty" else rng.choice([1, 5, 30, 100, 400])
            rows.append((doc, " ".join(["w"] * size), source))
            doc += 1
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_targets_and_taken(docs):
    got = mix.mix_table(docs).collect()
    sizes, taken, target = {}, {}, {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    want = brute_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6)
        assert abs(taken[s] - want[s]) <= max(40, 0.005 * want[s]), s
    assert all(r["source_size"] == sizes[r["source"]] for r in got)


def test_reruns_agree_and_counts_are_balanced(docs, monkeypatch):
    first = sorted(mix.mix_table(docs).select("doc_id", "copies").collect())
    assert first == sorted(mix.mix_table(docs.repartition(7)).select("doc_id", "copies").collect())
    monkeypatch.setattr(mix, "BLOCK_ROWS", 50)      # several rounds of blocks
    got = mix.mix_table(docs).collect()
    for s in ("a", "c"):
        own = [r for r in got if r["source"] == s]
        rate = own[0]["target"] / own[0]["source_size"]
        assert abs(sum(r["copies"] for r in own) - rate * len(own)) < 15
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) < 0.01 * own[0]["target"]


def test_one_step_keeps_totals_and_expectation():
    p, size = [0.3, 0.6, 0.5], [10.0, 4.0, 7.0]
    u = mix._direction(size)
    for draw in (0.0, 0.999):
        q = mix._step(p, u, draw)
        assert sum(q) == pytest.approx(sum(p)) and sum(a * b for a, b in zip(q, size)) == pytest.approx(
            sum(a * b for a, b in zip(p, size)))
        assert any(x < 1e-9 or x > 1 - 1e-9 for x in q)


def test_documents_come_as_often_as_taken(docs):
    copies = {r["doc_id"]: r["copies"] for r in mix.mix_table(docs).collect()}
    rows = mix.mixed_documents(docs).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in rows} == {d: c for d, c in copies.items() if c}
