import random

import numpy as np
import pytest

from tessera.llm import host_rules


def brute_repeats(words):
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= set(range(i, i + 5))
    return len(hit)


@pytest.mark.parametrize("vocabulary", [2, 5, 30])
def test_repeated_words(vocabulary):
    rng = random.Random(vocabulary)
    for n in (0, 1, 4, 5, 6, 40, 90):
        words = [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
        assert host_rules.measure(" ".join(words).encode())[4] == brute_repeats(words)


def test_large_vocabulary_takes_the_stepwise_codes():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 9000, 1500)
    ids[100:140] = ids[900:940]
    ids[-7:] = ids[10:17]
    assert 9000 ** 5 > 2 ** 63
    assert host_rules.repeated_words(ids.astype(np.int64), 9000) == brute_repeats(ids.tolist()) > 80


def test_measures():
    text = "Aé b\x0b#$ 中\n\n  \nAé b\x0b#$ 中\nx<|>"
    assert host_rules.measure(text.encode()) == (9, 16, 7, 1, 0, 3)


def good(i):
    return " ".join(f"word{i}x{j}" for j in range(40))


def test_hosts(docs):
    junk = " ".join(f"{w}$$$" for w in good(0).split())
    rows = ([(i, good(i), "open") for i in range(50)]
            + [(100 + i, junk if i < 30 else good(i), "mixed") for i in range(50)]
            + [(200 + i, "a b", "bad") for i in range(49)] + [(249, good(9), "bad")]
            + [(300, junk, "small"), (301, good(1), None), (302, None, None), (303, "", "open")])
    out = {r.doc_id: r for r in host_rules.apply_rules(docs(rows)).collect()}
    assert len(out) == len(rows)
    assert {out[i].host_verdict for i in range(50)} == {"open"} and all(out[i].kept for i in range(50))
    assert out[100].host_verdict == "strict" and not out[100].base_failed and not out[100].kept
    assert out[149].kept
    assert out[249].host_verdict == "blocked" and not out[249].kept and not out[249].base_failed
    # one failure of one document: the rate is shrunk towards all hosts
    assert 0.5 < out[300].host_rate < 1.0
    assert not out[302].kept and out[302].n_words == 0 and out[302].base_failed
    kept = host_rules.filter_documents(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in out.items() if r.kept)
    assert {r.n_words for r in kept.collect()} == {"mine"}


def test_repeated_rows_and_empty_table(docs):
    rows = [(1, good(1), "a")] * 3 + [(None, good(2), "a")]
    assert sorted(r.kept for r in host_rules.apply_rules(docs(rows)).collect()) == [True] * 4
    assert host_rules.apply_rules(docs([])).count() == 0
    assert host_rules.filter_documents(docs([])).count() == 0
