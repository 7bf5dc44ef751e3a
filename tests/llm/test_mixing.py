import random

import numpy as np
import pytest

from llm.conftest import SF
from tessera.llm import mixing
from tessera.llm.common import table


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, out, free = sum(sizes.values()), {}, set(sizes)
    while free:
        left = total - sum(out.values())
        weight = sum(w[s] for s in free)
        over = {s for s in free if left * w[s] / weight > most * sizes[s]}
        if not over:
            out.update({s: left * w[s] / weight for s in free})
            break
        out.update({s: most * sizes[s] for s in over})
        free -= over
    return out


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 10, 500, 4000, 100000]) for i in range(rng.randrange(1, 12))}
    sizes[None] = 30
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def check(rows, want_sizes):
    per = {}
    for r in rows:
        assert r.taken % r.size == 0 if r.size else r.taken == 0
        assert 0 <= r.taken <= 3 * r.size
        assert r.size == want_sizes[r.doc_id]
        t = per.setdefault((r.source_size, r.target), [0, 0])
        t[0] += r.taken
        t[1] = max(t[1], r.size)
    for (_, target), (taken, largest) in per.items():
        assert abs(taken - target) <= largest
    return per


def test_whole_table_and_reruns(spark):
    d = table(spark, SF, "documents")
    sizes = {r.doc_id: len((r.text or "").encode().split()) for r in d.collect()}
    rows = mixing.mix(d).collect()
    check(rows, sizes)
    again = mixing.mix(d.repartition(5)).collect()
    key = lambda r: (r.doc_id, r.taken)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_many_small_leaves_and_batches(spark, docs):
    rng = random.Random(2)
    rows = [(i, "x " * rng.randrange(0, 60), rng.choice("aaabc")) for i in range(1500)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = mixing.mix(docs(rows), leaves=27, fan_in=3).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(out) == len(rows)
    check(out, {i: len(t.split()) for i, t, _ in rows})


def settle_once(size, x, tree, seed):
    n = len(size)
    rng = np.random.default_rng(seed)
    spare = np.ones(n, dtype=bool)
    spare[:tree] = False
    order = np.argsort(-size, kind="stable")
    out = np.empty(n)
    out[order] = mixing.settle(size[order], x[order], spare[order], rng.random(n), rng.random(n))
    return out


def test_reserve_settles_what_a_large_document_leaves():
    rng = np.random.default_rng(1)
    size = np.concatenate([[20_000], rng.integers(1, 4000, 200)])
    x = np.concatenate([[0.4], np.full(200, 0.3)])
    runs = np.array([settle_once(size, x, 1, seed) for seed in range(3000)])
    assert set(np.unique(runs)) <= {0.0, 1.0}
    missed = np.abs(runs @ size - size @ x)
    # within a thousandth of the target; the tree alone leaves thousands of words
    assert np.quantile(missed, 0.99) <= 0.001 * (size @ x) and missed.max() <= 0.005 * (size @ x)
    # (the few smallest documents take what is left, cut at 0 and 1)
    off = abs(runs.mean(axis=0) - x)
    assert off[size >= 256].max() < 0.05 and abs(runs[:, 1:].mean() - 0.3) < 0.01


def test_targets_are_met(spark):
    # sources with documents from 1 to 20,000 words
    rng = random.Random(7)
    rows = [(i, "w " * int(min(20_000, 10 ** rng.uniform(0, 4.3))), rng.choice(["a", "b", "c", "d"])) for i in range(900)]
    frame = spark.createDataFrame([(*r, None) for r in rows], "doc_id long, text string, source string, size string")
    for seed in (1, 2):
        per = {}
        for r in mixing.mix(frame, seed=seed, leaves=16, fan_in=4).collect():
            t = per.setdefault((r.source_size, r.target), [0])
            t[0] += r.taken
            assert 0 <= r.taken <= 3 * r.size
        assert len(per) == 4 and all(abs(t[0] - target) <= 0.01 * target for (_, target), t in per.items())


def test_expectation_is_kept():
    rng = random.Random(0)
    total = [0.0, 0.0]
    for _ in range(20000):
        a, b = mixing.meet(0.3, 10, 0.8, 4, rng.random())
        assert a in (0.0, 1.0) or b in (0.0, 1.0)
        assert a * 10 + b * 4 == pytest.approx(0.3 * 10 + 0.8 * 4)
        total[0] += a
        total[1] += b
    assert total[0] / 20000 == pytest.approx(0.3, abs=0.02)
    assert total[1] / 20000 == pytest.approx(0.8, abs=0.02)


def test_nulls_repeats_and_empty_table(docs):
    rows = [(1, None, None), (2, "", "a"), (None, "a b c", "a"), (3, "a b c", "a"), (3, "a b c", "a"), (4, "z", None)]
    out = mixing.mix(docs(rows)).collect()
    assert len(out) == 6 and all(0 <= r.taken <= 3 * r.size for r in out)
    assert mixing.mix(docs([])).count() == 0
    assert mixing.mix(docs([(1, "", "a")])).collect()[0].taken == 0


def test_texts_of_the_mixture(spark):
    rows = [(1, "a b", "s", "x", 7), (1, "a b", "s", "x", 8), (None, "c", None, "y", None), (None, None, "c", "y", None),
            (2, "", "t", "z", 1), (3, "w " * 5000, "t", "z", 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, copies long")
    mixed = mixing.mix(frame).collect()
    got = mixing.mixed_texts(frame)
    assert got.columns == ["doc_id", "text", "source", "size", "copies"]
    copies = {}
    for r in mixed:
        copies[r.doc_id, r.size] = copies.get((r.doc_id, r.size), 0) + r.copies
    out = got.collect()
    assert {(r.doc_id, len((r.text or "").split())): r.copies for r in out} == {k: n for k, n in copies.items() if n}
    assert {(r.text, r.source) for r in out} <= {(t, s) for _, t, s, _, _ in rows}
    assert mixing.mixed_texts(frame.where("false")).count() == 0
