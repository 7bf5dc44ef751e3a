import random
import re

import pytest

from tessera.llm import decontaminate as D


def toks(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def sh(w, k):
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items, t=0.8):
    out = []
    for d, dt in docs:
        for i, it in items:
            w = toks(it)
            if w:
                k = min(5, len(w))
                have = sh(w, k)
                c = len(have & sh(toks(dt), k)) / len(have)
                if c >= t:
                    out.append((d, i, round(c, 9)))
    return sorted(out, key=repr)


@pytest.fixture()
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def run(docs, items):
    return sorted(((r.doc_id, r.item_id, round(r.containment, 9))
                   for r in D.contamination_report(docs, items).collect()), key=repr)


def test_against_brute_force(docs, items):
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(400)]
    it = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 2, 4, 5, 6, 9, 20, 45])))) for i in range(30)]
    it += [(90, None), (91, ""), (92, it[0][1]), (93, " ?! ")]
    rows = []
    for d in range(120):
        body = [rng.choice(vocab) for _ in range(rng.choice([0, 3, 50, 3000]))]
        for _ in range(rng.randrange(3)):
            w = it[rng.randrange(30)][1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = "edited"
            at = rng.randrange(len(body) + 1)
            body[at:at] = w
        rows.append((d, " ".join(body).upper() + "."))
    rows += [(500, None), (501, ""), (None, rows[3][1]), (3, rows[3][1])]
    want = brute(rows, it)
    assert len(want) > 50
    assert run(docs(rows), items(it)) == want
    left = D.drop_contaminated(docs(rows), items(it))
    assert left.columns == docs(rows).columns
    bad = {d for d, _, _ in want}
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted(
        (d for d, _ in rows if d not in bad), key=repr)


def test_empty_tables(docs, items):
    assert run(docs([]), items([(1, "a b c d e f")])) == []
    assert run(docs([(1, "a b c d e f")]), items([])) == []
    assert D.drop_contaminated(docs([(1, "x")]), items([])).count() == 1
    assert D.drop_contaminated(docs([]), items([(1, "x")])).count() == 0


def test_main_path_is_native(spark, docs, items):
    d = docs([(1, "a b c d e f g"), (2, "x")])
    for df in (D.contamination_report(d, items([(1, "a b c d e f")])), D.drop_contaminated(d, items([(1, "a b c d e f")]))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
