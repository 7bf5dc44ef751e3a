import heapq
import random

import pytest

from conftest import E1, E2, E3, parse_edges
from tessera.operators import paths as P
from tessera import (
    reachable_count,
    shortest_from_source,
    shortest_routes_to_target,
    shortest_to_target,
)


def routes(df):
    return {r.node: (r.distance, r.route) for r in df.collect()}


@pytest.mark.parametrize("rows,counts", [
    (E1, [4, 4, 4, 4, 4]),
    (E2, [4, 4, 4, 4, 4]),
    (E3, [4, 3, 3, 1, 1]),
])
def test_reachable_count(edges, rows, counts):
    df = edges(rows)
    got = [reachable_count(df, s).collect()[0].reachable for s in range(5)]
    assert got == counts


def test_reachable_count_absent_source_and_empty_graph(edges):
    assert reachable_count(edges(E3), 42).collect()[0].reachable == 0
    assert reachable_count(edges([]), 0).collect()[0].reachable == 0


EXPECTED_ROUTES = [
    (E2, 0, {0: (0.0, "0"), 1: (7.0, "1->2->4->0"), 2: (4.0, "2->4->0"),
             3: (6.0, "3->4->0"), 4: (2.0, "4->0")}),
    # regression: target != 0 and routes passing through node 0 are kept
    (E2, 1, {0: (10.0, "0->1"), 1: (0.0, "1"), 2: (3.0, "2->1"),
             3: (16.0, "3->4->0->1"), 4: (12.0, "4->0->1")}),
    (E2, 3, {0: (11.0, "0->1->3"), 1: (1.0, "1->3"), 2: (4.0, "2->1->3"),
             3: (0.0, "3"), 4: (6.0, "4->3")}),
    (E1, 0, {0: (0.0, "0"), 1: (11.0, "1->2->4->0"), 2: (9.0, "2->4->0"),
             3: (11.0, "3->4->0"), 4: (7.0, "4->0")}),
    (E3, 0, {0: (0.0, "0")}),
    (E3, 1, {0: (10.0, "0->1"), 1: (0.0, "1"), 2: (3.0, "2->1")}),
    (E2, 42, {}),
]


@pytest.mark.parametrize("rows,target,expected", EXPECTED_ROUTES)
def test_routes_to_target(edges, rows, target, expected):
    assert routes(shortest_routes_to_target(edges(rows), target)) == expected


def test_distances_to_target_match_routes(edges):
    got = {r.node: r.distance for r in shortest_to_target(edges(E2), 0).collect()}
    assert got == {0: 0.0, 1: 7.0, 2: 4.0, 3: 6.0, 4: 2.0}


def test_numeric_not_textual_minimum(edges):
    # As text "10.0" < "9.0"; the answer must be 9.0 via node 2.
    rows = parse_edges("1-0:10 1-2:1 2-0:8")
    assert routes(shortest_routes_to_target(edges(rows), 0))[1] == (9.0, "1->2->0")


def test_improved_node_keeps_only_best_route(edges):
    # node 3 first learns a 1-hop route (len 20), later a 3-hop one (len 3)
    rows = parse_edges("3-0:20 3-1:1 1-2:1 2-0:1")
    assert routes(shortest_routes_to_target(edges(rows), 0))[3] == (3.0, "3->1->2->0")


def test_tie_break_fewest_hops_then_smallest_next_hop(edges):
    # 5 -> 0 by 5->0 (4.0, 1 hop) or 5->1->0 (4.0, 2 hops): fewest hops wins;
    # 6 -> 0 by 6->3->0 or 6->2->0 (both 2.0, 2 hops): next hop 2 wins.
    rows = parse_edges("5-0:4 5-1:2 1-0:2 6-3:1 3-0:1 6-2:1 2-0:1")
    got = routes(shortest_routes_to_target(edges(rows), 0))
    assert got[5] == (4.0, "5->0")
    assert got[6] == (2.0, "6->2->0")


def test_parallel_edges_and_self_loops(edges):
    rows = parse_edges("1-0:5 1-0:2 1-1:0 0-0:3")
    assert routes(shortest_routes_to_target(edges(rows), 0)) == {0: (0.0, "0"), 1: (2.0, "1->0")}


@pytest.mark.parametrize("length", [-1.0, float("nan"), None])
def test_bad_length_fails(spark, length):
    from conftest import EDGE_DDL
    rows = spark.createDataFrame([(0, 0, 1, 1.0), (1, 1, 2, length)], EDGE_DDL.replace("double", "double"))
    for job in (shortest_from_source, shortest_routes_to_target, reachable_count):
        with pytest.raises(Exception, match="edge lengths must be"):
            job(rows, 0).collect()


def dijkstra(adj, source):
    dist = {source: 0.0}
    heap = [(0.0, source)]
    while heap:
        d, u = heapq.heappop(heap)
        if d > dist.get(u, float("inf")):
            continue
        for v, w in adj.get(u, []):
            if d + w < dist.get(v, float("inf")):
                dist[v] = d + w
                heapq.heappush(heap, (d + w, v))
    return dist


@pytest.mark.parametrize("seed", [1, 2])
def test_against_dijkstra_and_each_other(edges, seed):
    rnd = random.Random(seed)
    n = 25
    rows = [(i, rnd.randrange(n), rnd.randrange(n), float(rnd.randint(1, 9))) for i in range(70)]
    fwd, rev = {}, {}
    for _, a, b, w in rows:
        fwd.setdefault(a, []).append((b, w))
        rev.setdefault(b, []).append((a, w))
    df = edges(rows)
    src = rows[0][1]
    from_src = {r.node: r.distance for r in shortest_from_source(df, src).collect()}
    assert from_src == dijkstra(fwd, src)
    # shortest_to_target(E, x) == shortest_from_source(reversed E, x)
    to_tgt = routes(shortest_routes_to_target(df, src))
    assert {k: v[0] for k, v in to_tgt.items()} == dijkstra(rev, src)
    # each route is a real path whose edge lengths add up to its distance
    best = {}
    for _, a, b, w in rows:
        best[(a, b)] = min(w, best.get((a, b), float("inf")))
    for node, (d, route) in to_tgt.items():
        hops = [int(x) for x in route.split("->")]
        assert hops[0] == node and hops[-1] == src
        assert sum(best[(a, b)] for a, b in zip(hops, hops[1:])) == d
    # reachable_count == reached nodes - 1
    assert reachable_count(df, src).collect()[0].reachable == len(from_src) - 1


def test_round_guard(edges):
    # two ways at each step, so nothing is contracted
    steps = parse_edges("0-10:1 0-20:1 10-11:1 10-21:1 20-21:1 20-11:1 11-12:1 11-22:1 21-22:1 21-12:1 12-13:1 22-13:1 13-12:9")
    with pytest.raises(RuntimeError, match="did not converge"):
        shortest_from_source(edges(steps), 0, max_rounds=2)
    assert len(shortest_from_source(edges(steps), 0, max_rounds=10).collect()) == 8


def graph(rnd, n, m, weight):
    return [(i, rnd.randrange(n), rnd.randrange(n), float(weight(rnd))) for i in range(m)]


def adjacency(rows):
    fwd = {}
    for _, a, b, w in rows:
        fwd.setdefault(a, []).append((b, w))
    return fwd


@pytest.mark.parametrize("delta", [4.0])
def test_delta_stepping_gives_the_same_distances_and_routes(edges, delta):
    rnd = random.Random(int(delta * 10))
    rows = graph(rnd, 40, 130, lambda r: r.choice([0, 0.25, 1, 3, 8, 20]))
    df, src = edges(rows), rows[0][1]
    got = {r.node: r.distance for r in shortest_from_source(df, src, delta=delta).collect()}
    assert got == dijkstra(adjacency(rows), src)
    assert routes(shortest_routes_to_target(df, src, delta=delta)) == routes(shortest_routes_to_target(df, src))


def test_delta_stepping_expands_fewer_rows(edges):
    # many hops of length 1 beside long edges: the plain loop sees each node at
    # many distances, and expands its many edges each time
    n = 6
    rows = [(0, i, j, 1.0 if j == i + 1 else 3.0 * (j - i)) for i in range(n) for j in range(i + 1, n)]
    expanded = {}
    for delta in (float("inf"), 1.0):
        counts = []
        out = P._distances(edges(rows), 0, False, None, delta, lambda grown: counts.append(grown.count()))
        assert {r.node: r.distance for r in out.collect()} == dijkstra(adjacency(rows), 0)
        expanded[delta] = sum(counts)
    # each edge once, against each edge as often as its source improves
    assert expanded[1.0] == len(rows)
    assert expanded[float("inf")] > 1.5 * expanded[1.0]


def test_long_path_takes_few_rounds(edges):
    rnd = random.Random(3)
    n = 10_000
    rows = [(i, i, i + 1, float(rnd.randint(1, 9))) for i in range(n)]
    rows += [(0, 4000, 20_000, 1.0), (0, 20_000, 4100, 2.0), (0, 30_000, 30_001, 1.0), (0, 30_001, 30_002, 1.0),
             (0, 30_002, 30_000, 1.0), (0, 7000, 6000, 1.0), (0, 50, 60_000, 1.0)]
    df = edges(rows)
    got = {r.node: r.distance for r in shortest_from_source(df, 0, max_rounds=12).collect()}
    assert got == dijkstra(adjacency(rows), 0)
    levels = {r.node: r.level for r in P.reachable_nodes(df, 0, max_rounds=12).collect()}
    assert levels == dijkstra(adjacency([(i, a, b, 1.0) for i, a, b, _ in rows]), 0)


@pytest.mark.parametrize("seed", [1])
def test_contracted_chains_against_dijkstra_and_routes(edges, seed):
    # a few branching nodes, joined by chains of 0 to 12 nodes; cycles of their own
    rnd = random.Random(seed)
    rows, fresh = [], 1000
    for _ in range(14):
        at = rnd.randrange(6)
        for _ in range(rnd.randint(0, 12)):
            rows.append((0, at, fresh, float(rnd.randint(0, 4))))
            at, fresh = fresh, fresh + 1
        rows.append((0, at, rnd.randrange(6), float(rnd.randint(0, 4))))
    rows += [(0, 500 + i, 500 + (i + 1) % 4, 1.0) for i in range(4)]
    df = edges(rows)
    back = adjacency([(i, b, a, w) for i, a, b, w in rows])
    for origin in (1000, 501):
        assert {r.node: r.distance for r in shortest_from_source(df, origin).collect()} == dijkstra(adjacency(rows), origin)
    # the best route by (distance, hops, next hop) of each node, by plain relaxation
    best = {0: (0.0, 0, -1)}
    while True:
        new = dict(best)
        for b, out in back.items():
            for a, w in out:
                if b in new and a != b:
                    cand = (new[b][0] + w, new[b][1] + 1, b)
                    if a not in new or cand < new[a]:
                        new[a] = cand
        if new == best:
            break
        best = new
    want = {}
    for v in best:
        route = [v]
        while route[-1] != 0:
            route.append(best[route[-1]][2])
        want[v] = (best[v][0], "->".join(map(str, route)))
    assert routes(shortest_routes_to_target(df, 0)) == want


def test_state_is_written_as_deltas_and_nothing_of_it_is_cached(spark, edges, monkeypatch):
    # a grid: some 10 rounds, so the deltas are merged into a base, twice
    monkeypatch.setattr(P, "MAX_DELTAS", 2)
    rows = [(0, 6 * y + x, 6 * y2 + x2, 1.0) for y in range(6) for x in range(6)
            for x2, y2 in ((x + 1, y), (x, y + 1)) if x2 < 6 and y2 < 6]
    written, bases, cached = [], [], []
    add, merge = P._State.add, P._State._merge

    def spy_add(self, changed, *counts):
        out = add(self, changed, *counts)
        written.append(out[0].count())
        cached.append(spark.sparkContext._jsc.getPersistentRDDs().size())
        return out

    def spy_merge(self, whole):
        merge(self, whole)
        bases.append(whole)

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    monkeypatch.setattr(P._State, "add", spy_add)
    monkeypatch.setattr(P._State, "_merge", spy_merge)
    out = shortest_from_source(edges(rows), 0)
    assert {r.node: r.distance for r in out.collect()} == dijkstra(adjacency(rows), 0)
    assert sum(written) == 36 and max(written) == 6      # each node once, in its round
    assert True in bases and False in bases
    assert max(cached) <= before + 1                        # the edges alone
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("tessera_state")]
