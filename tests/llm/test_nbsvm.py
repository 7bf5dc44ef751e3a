import zlib

import numpy as np
import pytest

from llm.conftest import SF
from tessera.llm import nbsvm
from tessera.llm.common import table


def test_held_out_accuracy_and_whole_table(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    out = {r.doc_id: r for r in nbsvm.classify(docs, labels).collect()}
    assert len(out) == docs.count()
    quality = {r.doc_id: r.quality for r in labels.collect()}
    held = [i for i, r in out.items() if r.held_out and i in quality]
    for i, r in out.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.3)
    assert np.mean([out[i].predicted == quality[i] for i in held]) > 0.95
    low = [out[i].score for i in held if not quality[i]]
    high = [out[i].score for i in held if quality[i]]
    assert np.mean([a < b for a in low for b in high]) > 0.98


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(40, 8, replace=False)) for _ in range(120)]
    truth = rng.normal(size=40)
    y = np.array([1.0 if truth[r].sum() > 0 else -1.0 for r in rows])
    ratio = rng.normal(size=40)
    w, b = nbsvm.descend(rows, y, ratio, epochs=400)
    x = np.zeros((120, 41))
    for i, r in enumerate(rows):
        v = ratio[r] / np.linalg.norm(ratio[r])
        x[i, r], x[i, 40] = v, 1.0

    def loss(u):
        return u @ u / 2 + np.maximum(0, 1 - y * (x @ u)).sum()
    # no random or gradient step from the solution lowers the primal objective
    u = np.append(w, b)
    best = loss(u)
    for scale in (1e-1, 1e-2, 1e-3):
        for _ in range(200):
            assert loss(u + rng.normal(size=41) * scale) > best - 0.01


def test_ratios_count_all_training_rows(spark, docs):
    rows = [(i, "good words here" if i % 2 else "bad $$$ stuff") for i in range(40)]
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(40)] + [(3, None), (None, 1), (7, 1), (999, 0)], "doc_id long, quality int")
    d = docs(rows)
    model = nbsvm.train(d, labels, d.doc_id >= 10)
    good, bad = nbsvm.indicators(b"good"), nbsvm.indicators(b"$$$")
    only = lambda f: [i for i in f if model.ratio[i]]
    assert {round(float(model.ratio[i]), 6) for i in only(good)} != set()
    assert model.score(nbsvm.indicators(b"good words here")) > 0.8 > 0.2 > model.score(nbsvm.indicators(b"bad $$$ stuff"))
    assert bad is not None


def test_edge_cases(spark, docs):
    rows = [(1, None), (2, ""), (3, "x " * 50000), (None, "a b"), (4, "a b"), (4, "a b")]
    empty = spark.createDataFrame([], "doc_id long, quality int")
    out = nbsvm.classify(docs(rows), empty).collect()
    assert len(out) == 6 and all(r.score == pytest.approx(0.5) for r in out)
    one = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 1)], "doc_id long, quality int")
    assert all(r.score > 0.99 for r in nbsvm.classify(docs(rows), one).collect())
    assert nbsvm.classify(docs([]), one).count() == 0
    assert nbsvm.indicators(b"").size == 1


def test_sample_holds_a_rare_class(spark, docs):
    rows = [(i, f"bad $$$ stuff {i}" if i % 100 else f"good words here {i}") for i in range(1000)]
    # most labelled ids are not among the documents
    labels = spark.createDataFrame([(i, int(i % 100 == 0)) for i in range(1000)] + [(i, 0) for i in range(10 ** 6, 10 ** 6 + 3000)],
                                   "doc_id long, quality int")
    d = docs(rows)
    model = nbsvm.train(d, labels, d.doc_id >= 0, fit_rows=12)
    good, bad = (model.score(nbsvm.indicators(x)) for x in (b"good words here 5", b"bad $$$ stuff 5"))
    assert good > 10 * bad and bad < 0.1 and model.weight.any()
