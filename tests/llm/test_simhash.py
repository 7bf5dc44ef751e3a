import random
from itertools import combinations

import pytest
import xxhash

from llm.conftest import SF
from tessera.llm import simhash
from tessera.llm.common import table
from tessera.llm.components import connected_components


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    if len(words) < 3:
        shingles = [" ".join(words)]
    else:
        shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints, radius=3):
    """{doc_id: smallest doc_id reachable} from {doc_id: fingerprint}."""
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in combinations(ids, 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in ids}


def check(rows, df):
    want_fp = {i: brute_fingerprint(t) for i, t in rows}
    want = brute_components(want_fp)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in df.collect()}
    assert got == {i: (f"{want_fp[i]:016x}", want[i]) for i in want_fp}


@pytest.mark.parametrize("limit", [simhash.SHARD_LIMIT, 3])
def test_whole_table_against_brute_force(spark, limit):
    d = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()]
    check(rows, simhash.near_duplicates(d, shard_limit=limit))


@pytest.mark.parametrize("limit", [2048, 4])
def test_close_fingerprints_and_chains(spark, limit):
    # a chain of fingerprints 3 bits apart, a dense ball, and random ones
    rng = random.Random(5)
    chain = [rng.getrandbits(64)]
    for _ in range(40):
        nxt = chain[-1]
        for b in rng.sample(range(64), 3):
            nxt ^= 1 << b
        chain.append(nxt)
    centre = rng.getrandbits(64)
    ball = [centre] + [centre ^ (1 << i) ^ (1 << j) for i, j in combinations(range(20), 2)]
    fps = list(dict.fromkeys([*chain, *ball, *(rng.getrandbits(64) for _ in range(100))]))
    rng.shuffle(fps)
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)]
    labels = simhash.fingerprint_components(
        spark.createDataFrame(signed, "doc_id long, fp long"), shard_limit=limit)
    by_fp = {r.fp & (2 ** 64 - 1): r.label for r in labels.collect()}
    want = brute_components(dict(enumerate(fps)))
    groups = {}
    for i, f in enumerate(fps):
        groups.setdefault(want[i], set()).add(by_fp[f])
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_bk_tree_finds_all_within_radius():
    rng = random.Random(1)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in range(0, 4096, 37):
        for radius in (0, 1, 3):
            got = sorted(tree.search(q, radius))
            # equal values share a node's place: compare as values
            assert {tree.values[i] for i in got} == {v for v in values if (v ^ q).bit_count() <= radius}


def test_nulls_empties_repeats_and_long_texts(docs):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [(5, None), (3, ""), (4, " \n"), (7, "Only"), (9, "only"), (2, "a b"), (8, long), (1, long + " end"),
            (6, "a b"), (6, "a b"), (None, "a b"), (None, "lonely words here indeed")]
    out = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs(rows)).collect()}
    assert out >= {(5, 3), (3, 3), (4, 3), (7, 7), (9, 7), (2, 2), (6, 2), (None, 2), (8, 1), (1, 1), (None, None)}
    kept = simhash.drop_near_duplicates(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 1), (False, 2), (False, 3), (False, 7), (True, 0)]


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    assert simhash.drop_near_duplicates(docs([])).count() == 0


def test_components_of_a_star_and_a_path(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 600)]
    edges = spark.createDataFrame([*path, *star, (7, 7), (None, 3), (900, 899), (900, 899)],
                                  "a long, b long")
    got = {r.node: r.label for r in connected_components(edges).collect()}
    assert {got[i] for i in range(100, 141)} == {100}
    assert {got[i] for i in range(500, 600)} == {500}
    assert got[900] == 899 and 7 not in got and 3 not in got


def test_components_take_few_rounds(spark, monkeypatch):
    from tessera.llm import components
    rng = random.Random(6)
    n = 1024
    zigzag = [0, *range(n - 1, 0, -1)]
    mixed = list(range(n))
    rng.shuffle(mixed)
    edges, want = [], {}
    for base, path in ((0, zigzag), (10_000, mixed)):
        edges += [(base + a, base + b) for a, b in zip(path, path[1:])]
        want.update({base + a: base for a in path})
    edges += [(30_000, 30_000 + i) for i in range(1, 200)] + [(40_000 - i, 40_000) for i in range(1, 200)]
    want.update({30_000 + i: 30_000 for i in range(200)} | {40_000 - i: 39_801 for i in range(200)})
    edges += [(5, 5), (None, 3), (4, None)]
    written = []
    write = components.write_table
    monkeypatch.setattr(components, "write_table", lambda df, label: (written.append(label), write(df, label))[1])
    out = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.label for r in out.collect()} == want
    assert written.count("cc-state") <= 8 and len(written) <= 60
