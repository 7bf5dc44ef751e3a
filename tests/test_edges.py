import pytest

from conftest import E1, E2, E3
from tessera import adjacency_text, avg_in_length, avg_out_length, graph_nodes, reverse_adjacency


def as_dict(df, k="node", v="avg_length"):
    return {r[k]: r[v] for r in df.collect()}


@pytest.mark.parametrize("rows,expected", [
    (E1, {0: 7.0, 1: 6.5, 2: 3.5, 3: 5.0, 4: 3.0}),
    (E2, {0: 3.5, 1: 6.5, 2: 3.0, 3: 16 / 3, 4: 3.0}),
    (E3, {1: 6.5, 2: 3.0, 3: 16 / 3, 4: 3.0}),
])
def test_avg_in_length(edges, rows, expected):
    got = as_dict(avg_in_length(edges(rows)))
    assert got.keys() == expected.keys()
    for k, v in expected.items():
        assert got[k] == pytest.approx(v)


@pytest.mark.parametrize("rows,expected", [
    (E1, [(0, 7.5), (4, 6.0), (2, 14 / 3), (3, 4.0), (1, 1.5)]),
    (E2, [(0, 10.0), (2, 4.75), (3, 4.0), (4, 4.0), (1, 2.0)]),
    (E3, [(0, 10.0), (4, 6.0), (2, 14 / 3), (3, 4.0), (1, 2.0)]),
])
def test_avg_out_length_order(edges, rows, expected):
    got = [(r.node, r.avg_length) for r in avg_out_length(edges(rows)).collect()]
    assert [n for n, _ in got] == [n for n, _ in expected]
    assert [a for _, a in got] == pytest.approx([a for _, a in expected])


@pytest.mark.parametrize("rows", [E1, E2, E3])
def test_graph_nodes(edges, rows):
    assert sorted(r.node for r in graph_nodes(edges(rows)).collect()) == [0, 1, 2, 3, 4]


def lists(df):
    return {(r.node, r.segment): r.neighbors for r in df.collect()}


def test_reverse_adjacency_e3(edges):
    got = lists(adjacency_text(reverse_adjacency(edges(E3))))
    assert got == {(0, 0): "", (1, 0): "0:10.0,2:3.0", (2, 0): "1:3.0",
                   (3, 0): "1:1.0,2:9.0,4:6.0", (4, 0): "2:2.0,3:4.0"}


def test_reverse_adjacency_duplicates(edges):
    # exact duplicates once; a parallel edge of another length is kept;
    # "1:1.0" must not be taken for part of "11:1.0"; lengths are not rounded
    rows = [(0, 1, 5, 1.2), (1, 1, 5, 1.2), (2, 1, 5, 1.7), (3, 11, 5, 1.0)]
    got = lists(adjacency_text(reverse_adjacency(edges(rows))))
    assert got == {(5, 0): "1:1.2,1:1.7,11:1.0", (1, 0): "", (11, 0): ""}


@pytest.mark.parametrize("width", [1, 3, 8, 1000])
def test_reverse_adjacency_segments(edges, width):
    # sparse 64-bit ids, parallel edges and exact copies at one node
    big = 2 ** 53
    rows = [(i, i * big // 7, 99, float(i % 3)) for i in range(-20, 30)]
    rows += [(i, 5, 99, float(i)) for i in range(12)] + [(0, big + 1, 99, 1.0), (0, big, 99, 1.0)] * 3
    rows += [(51, 30, 7, 2.0), (52, -3, 7, 2.0)]
    got = lists(reverse_adjacency(edges(rows), segment_items=width))
    want = {}
    for node in {r[1] for r in rows} | {r[2] for r in rows}:
        items = sorted({(f, w) for _, f, t, w in rows if t == node})
        want[node, 0] = []
        for i in range(0, len(items), width):
            want[node, i // width] = items[i:i + width]
    assert {k: [tuple(x) for x in v] for k, v in got.items()} == want
    assert max(map(len, got.values())) <= width


def test_hot_key_is_numbered_by_ranges(spark):
    from pyspark.sql import functions as F
    from tessera.operators.grouping import collect_segments
    rows = spark.range(30_000).select((F.col("id") % 3 % 2).alias("key"), (F.col("id") * 977 % 30_011).alias("item"))
    out = collect_segments(rows, "key", "item", "items", 1000).collect()
    for key in (0, 1):
        items = sorted(i * 977 % 30_011 for i in range(30_000) if i % 3 % 2 == key)
        mine = sorted((r.segment, r["items"]) for r in out if r.key == key)
        assert [s for s, _ in mine] == list(range(len(items) // 1000)) and sum((x for _, x in mine), []) == items
