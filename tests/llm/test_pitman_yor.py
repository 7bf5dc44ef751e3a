import math
import zlib
from collections import Counter

import numpy as np
import pytest

from llm.conftest import SF
from tessera.llm import pitman_yor as P
from tessera.llm.common import table
from tessera.session import ensure_checkpoint_dir


def words(text):
    return (text or "").encode().lower().split() + [None]


def brute_base(rows, held):
    counts = Counter(w for (i, t) in rows if not held(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        ws = words(t)
        out.append((i, held(i), len(ws), sum(counts[w] > 0 for w in ws), n,
                    sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)))
    return out


def crc_held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2


def test_base_score_against_brute_force_and_better_model(spark):
    sf = SF.replace("0.001", "0.01")
    d = table(spark, sf, "documents")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    want = {r[0]: r for r in brute_base(rows, crc_held)}
    scored = P.score_documents(d)
    got = {r.doc_id: r for r in scored.collect()}
    assert set(got) == set(want)
    for i, r in got.items():
        w = want[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[1:5]
        assert r.base_score == pytest.approx(w[5])
        assert r.score < 0
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    summary = {r.held_out: r for r in P.perplexity(scored).collect()}
    assert summary[True].perplexity < summary[True].base_perplexity


def one_part(rows, held):
    """The partition of a vocabulary that is not cut, and the totals of every sweep."""
    texts = [P.tokens((t or "").encode()) for _, t in rows]
    (_, packet), = P.packets(texts, [0])
    part = P.count_part([(len(rows), np.array([held(i) for i, _ in rows]), packet)])
    first = P.first_totals(int(part.count.sum()), len(part.words), int((part.count == 1).sum()),
                           int((part.count == 2).sum()),
                           np.bincount(part.context, part.count, P.CONTEXTS).astype(int),
                           np.bincount(part.context, minlength=P.CONTEXTS))
    history = [first]
    for _ in range(P.BURN_IN + P.SAMPLES):
        *_, (tables, _, own) = P.replay(part, history)
        history.append(first._replace(tables=np.bincount(part.context, tables, P.CONTEXTS).astype(int),
                                      parent_customers=int(tables.sum()), parent_tables=int(own.sum())))
    return part, history


def brute_scores(rows, held):
    """The model by dictionaries and one customer after another."""
    end = (1 << 64) - 1

    def steps(text):
        ws = [P._word(w) for w in (text or "").encode().lower().split()]
        before = [P._word(b""), *ws]
        return list(zip(before, [*ws, end], strict=True))

    def klass(u):
        return int(P._context(np.array([u], np.uint64))[0])

    def draws(w, u, number):
        key = P.dish_keys(np.array([w], np.uint64), np.array([u]), number)
        return lambda n: float(P.uniform(key, n)[0])

    def sit(c, odds, d, draw):
        t = 1
        for n in range(1, c):
            t += draw(n) < odds / (odds + n - d * t)
        return t

    c = Counter((w, klass(u)) for i, t in rows if not held(i) for u, w in steps(t))
    words = {w for w, _ in c}
    c_u = Counter()
    for (_, u), n in c.items():
        c_u[u] += n
    ones, twos = (sum(n == k for n in c.values()) for k in (1, 2))
    d, e, theta, v = min(0.95, max(0.1, ones / max(1, ones + 2 * twos))), P.PARENT_DISCOUNT, P.THETA, len(words)
    t, s = dict.fromkeys(c, 1), dict.fromkeys(words, 1)
    samples = []
    for number in range(P.BURN_IN + P.SAMPLES + 1):
        if number:
            t = {(w, u): sit(n, (theta + d * t_u[u]) * p[w], d, draws(w, u, number)) for (w, u), n in c.items()}
        c_w, t_u = Counter(), Counter()
        for (w, u), k in t.items():
            c_w[w] += k
            t_u[u] += k
        if number:
            base = (theta + e * sum(s.values())) / (v + 1)
            s = {w: sit(c_w[w], base, e, draws(w, P.CONTEXTS, number)) for w in words}
        whole = theta + sum(c_w.values())
        rest = (theta + e * sum(s.values())) / whole / (v + 1)
        p = {w: (c_w[w] - e * s[w]) / whole + rest for w in words}
        if number > P.BURN_IN:
            samples.append((t, t_u, p, rest))

    def mean(f):
        return sum(f(x) for x in samples) / len(samples)

    def chance(u, w):
        own = mean(lambda x: c[w, u] - d * x[0][w, u]) if (w, u) in c else 0.0
        back = mean(lambda x: theta + d * x[1][u])
        return (own + back * mean(lambda x: x[2].get(w, x[3]))) / (theta + c_u[u])

    return {i: sum(math.log10(chance(klass(u), w)) for u, w in steps(t)) for i, t in rows}


def some_rows(n, seed=4):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    share = 1 / np.arange(1, 41)
    return [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 40), p=share / share.sum())) + " x" * (i % 4)
             + (f" only{i}" if i % 5 == 0 else "")) for i in range(n)]


def test_scores_against_brute_force_at_any_number_of_partitions(spark, docs):
    rows = some_rows(25)
    part, _ = one_part(rows, crc_held)
    assert part.count.max() <= P.HEAD and part.unigram.max() > P.HEAD / 2      # all drawn one by one
    want = brute_scores(rows, crc_held)
    width = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (3, 8):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = {r.doc_id: r.score for r in P.score_documents(docs(rows)).collect()}
            assert got == pytest.approx(want, rel=1e-9)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


def test_scored_probabilities_sum_to_one():
    """What the scoring step looks up, over every known word and one unknown
    word: after frequent, rare and unseen contexts."""
    part, history = one_part(some_rows(300), lambda i: i % 7 == 2)
    model = P.Model(part, history)
    unseen = np.array([P._word(b"never seen")], np.uint64)
    words = np.concatenate([part.words, unseen])
    place, known = model.find(words)
    assert known.sum() == len(part.words) and not known[-1]
    before = [P._word(w) for w in (b"", b"w0", b"w1", b"w39", b"x", b"only0")] + [int(unseen[0])]
    for u in before:
        klass = int(P._context(np.array([u], np.uint64))[0])
        prob = model.probability(place, known, np.full(len(words), klass))
        assert (prob > 0).all()
        assert prob.sum() == pytest.approx(1.0, abs=1e-9)


def test_seating_has_the_distribution_of_one_by_one(monkeypatch):
    """Mean and spread of the tables, with most customers beyond the first."""
    rng = np.random.default_rng(1)
    n = 3000
    keys = rng.integers(0, 1 << 63, n).astype(np.uint64)
    for customers, odds, d in ((30, 2.0, 0.5), (2000, 5.0, 0.3), (2000, 0.05, 0.9), (500, 300.0, 0.5),
                               (2000, 3.0, 0.9), (2000, 40.0, 0.9)):
        got = P.seat(np.full(n, customers), np.full(n, odds), d, keys)
        t = np.ones(n)
        for k in range(1, customers):
            t += rng.random(n) < odds / (odds + k - d * t)
        error = 4 * math.sqrt(2) * t.std() / math.sqrt(n)
        assert got.mean() == pytest.approx(t.mean(), abs=error)
        assert got.std() == pytest.approx(t.std(), rel=0.1)
    assert (P.seat(np.array([1, 1]), np.array([9.0, 9.0]), 0.9, keys[:2]) == 1).all()
    # blocks end where the same draws end one by one, however they are cut
    for cells in (1 << 20, 700):
        monkeypatch.setattr(P, "CELLS", cells)
        got = P.seat(np.full(5, 1500), np.full(5, 40.0), 0.9, keys[:5])
        t = np.ones(5, dtype=int)
        for k in range(1, 1500):
            t += P.uniform(keys[:5], k) < 40 / (40 + k - 0.9 * t)
        assert np.array_equal(got, t)
    # a dish's tables do not depend on its neighbours
    odds, many = np.tile([0.5, 3.0, 9.0], n // 3), rng.integers(1, 20_000, n)
    all_at_once = P.seat(many, odds, 0.4, keys)
    assert np.array_equal(all_at_once[::7], P.seat(many[::7], odds[::7], 0.4, keys[::7]))
    assert (all_at_once <= many).all()


def test_a_partitions_counts_are_read_back():
    part, _ = one_part(some_rows(50), lambda i: i % 7 == 2)
    again = P._unpack_part(P._pack_part(part))
    assert all(np.array_equal(x, y) for x, y in zip(part, again, strict=True))


def test_nothing_is_left_but_the_scores(spark, docs):
    import os
    folder = f"{ensure_checkpoint_dir(spark)}/tables".removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    P.score_documents(docs(some_rows(10)))
    assert [x.split("-")[0] for x in set(os.listdir(folder)) - before] == ["scores"]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("tessera_packets")]


def test_packets_hold_every_token():
    texts = [P.tokens(t.encode()) for t in ("a b A", "", "x " * 700, "b a", "a b A")]
    seen = Counter()
    for _, packet in P.packets(texts, [3, 5, 9]):
        q = P.Packet.unpack(packet.pack())
        assert all(np.array_equal(x, y) for x, y in zip(packet, q))
        for w, d, n in zip(np.repeat(q.words, q.runs), q.docs, q.counts):
            seen[int(w), int(d)] += int(n)
    want = Counter()
    for d, t in enumerate(texts):
        for w in t:
            want[P._word(w), d] += 1
        want[(1 << 64) - 1, d] += 1
    assert seen == want


def test_edge_cases(docs):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b"), (4, "long " * 70000), (9, " \n")]
    d = docs(rows)
    key = lambda r: (str(r[0]), *r[1:5])
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score)
                  for r in P.score_documents(d).collect()), key=key)
    want = sorted(brute_base(rows, crc_held), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])
    none = P.score_texts(d, d.text.isNull() | d.text.isNotNull()).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.score == 0 and r.base_score == 0 for r in none)
    assert P.score_documents(docs([])).count() == 0
