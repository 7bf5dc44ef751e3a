import itertools
import random
import re
from collections import Counter

import pytest

from llm.conftest import SF
from tessera.llm import filter_audit as fa
from tessera.llm.common import table

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
           "toxic_lost", "shapley")


def failures(rows):
    """Failed filters of (doc_id, text) rows, in plain Python."""
    ids = {}
    for i, text in rows:
        if i is not None:
            ids.setdefault(text or "", []).append(i)
    out = []
    for i, text in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        f = "A" * (len(w) < 50) + "B" * (100 * len(set(w)) < 65 * len(w))
        f += "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text))
        f += "D" * bool(re.search(r"[#$%&*|]", text))
        f += "E" * (i is not None and any(j < i for j in ids[text]))
        out.append(f)
    return out


def brute(rows, labels):
    """Filters applied one after the other, document by document."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    parts = {}
    for (i, _, source), f in zip(rows, failures([r[:2] for r in rows])):
        parts.setdefault(source or "", []).append((i, f))
    out = {}
    for part, docs in parts.items():
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                shapley[x] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(x in f for _, f in docs) - len(gone),
                    sum(f == x for _, f in docs), sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return sorted((*k, *v) for k, v in out.items())


def got(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())


def random_text(rng):
    words = [rng.choice(["alpha", "Beta", "GAMMA", "été", "x#y", "漢字", "w"]) + str(rng.randint(0, 60))
             for _ in range(rng.choice([0, 3, 49, 50, 80]))]
    return rng.choice([" ", "\n", "\t\x0b "]).join(words)


def test_report_equals_brute_force(spark, docs):
    rng = random.Random(2)
    texts = [random_text(rng) for _ in range(40)]
    rows = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""])) for i in range(150)]
    rows += [(7, texts[0], "a"), (7, texts[0], "a"), (None, texts[0], "b"), (None, texts[0], "b"),
             (500, None, "c"), (501, "", "c"), (502, "only this", "d"), (-5, "only this", "d")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(160)]
    labels += [(3, 1, 1), (3, 0, 0), (None, 1, 1)]
    full = [(*r[:2], r[2] if r[2] is not None else None) for r in rows]
    frame = spark.createDataFrame([(i, t, None, s, None, "x", 9) for i, t, s in full],
                                  "doc_id long, text string, lang string, source string, n_chars long, "
                                  "part string, mask int").repartition(3)
    known = spark.createDataFrame([(*x, "clash") for x in labels], "doc_id long, quality int, toxic int, part string")
    assert got(fa.audit(frame, known)) == brute(full, [x for x in labels if x[0] is not None])


def test_whole_table(spark):
    rows = [(r.doc_id, r.text, r.source) for r in table(spark, SF, "documents").collect()]
    labels = [tuple(r) for r in table(spark, SF, "labels").select("doc_id", "quality", "toxic").collect()]
    assert got(fa.audit(table(spark, SF, "documents"), table(spark, SF, "labels"))) == brute(rows, labels)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_plain_changes_give_every_order_once(n):
    order = list(range(n))
    seen = {tuple(order)}
    for at in fa.plain_changes(n):
        order[at], order[at + 1] = order[at + 1], order[at]
        seen.add(tuple(order))
    changes = 1
    for i in range(2, n + 1):
        changes *= i
    assert len(seen) == changes == len(fa.plain_changes(n)) + 1


def test_swaps_keep_the_function_and_share_subgraphs():
    rng = random.Random(1)
    counts = {m: (rng.randint(0, 2), 0, 0) for m in range(32)}
    diagram = fa.Diagram(counts, 5)
    for at in fa.plain_changes(5):
        diagram.swap(at)
        assert diagram.root.weight[0] == sum(c[0] for c in counts.values())
        for mask, weight in counts.items():
            node = diagram.root
            for f in diagram.order:
                node = node.failed if mask >> f & 1 else node.passed
            assert node.weight == weight
        assert all(len(level) <= 2 ** i for i, level in enumerate(diagram.levels))
    flat = fa.Diagram(dict.fromkeys(range(32), (1, 0, 0)), 5)
    assert [len(level) for level in flat.levels] == [1] * 5     # one function, one node a level


def test_empty_tables_and_a_very_long_text(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.audit(docs([(1, "a")]).limit(0), labels).collect() == []
    rows = [(1, "word " * 400_000, "s"), (2, "word " * 400_000, "s"), (3, "", "s")]
    assert got(fa.audit(docs(rows), labels)) == brute(rows, [])


def test_hot_text_and_hot_id_are_spread(spark):
    rows = [(i, "one text of many copies", None, "s", None) for i in range(3000)]
    rows += [(5, "one row often", None, "t", None)] * 2000
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int")
    masks = fa.failure_masks(frame.repartition(4))
    assert masks.where("part = 's' and mask >= 16").count() == 2999
    assert masks.where("part = 't' and mask >= 16").count() == 0
    out = {(r.filter_order, r.part): r for r in fa.audit(frame, labels).where("step = 1").collect()}
    assert out["EABCD", "s"].removed == 2999 and out["ABCDE", "t"].good_lost == 2000
