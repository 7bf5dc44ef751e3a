"""Iterative graph jobs as DataFrame fixpoints: reachability (BFS), shortest
distances from a source, and shortest distances with routes to a target.

Execution model, the same for all of them:

* *Edges* are cleaned once (parallel edges reduced to the shortest), written, and
  cached partitioned and sorted on ``(src, salt)``. A *hub*, a node with more
  than E / 4P of the E edges (P partitions; so there are fewer than 4P hubs), has
  its edges dealt to several salts, and no partition owns more than a few
  shares of E / 4P edges of one node.
* *Chains*: if an eighth of the nodes have one edge in and one out, chains of them
  become single edges before the search, by pointer doubling, and get their values
  after it: a path of n nodes takes about log2 n rounds.
* The *state* has a row for each node reached so far, and grows by deltas: a round
  writes the nodes that it changed and nothing else. A node's value is the
  smallest of its rows. Deltas are merged into a base table, bucketed on the
  node, when they have a quarter of its rows, so a row is rewritten a few
  times however many rounds there are; nothing of the state lies in the executors,
  so a lost one costs the tasks of one round.
* *Semi-naive*: a round expands only the nodes that the last one changed, so the
  frontier (a hub's row once per salt) and the candidates move, reduced with
  ``min`` per node in the map tasks. Candidates meet the base in its buckets.
* *Delta-stepping* (weighted jobs on large graphs): changed nodes wait until the
  search has come to their bucket of distances, of width ``delta``; within a bucket
  only edges up to ``delta`` long are followed, and the longer ones once for each
  node when its bucket is settled. A node whose distance still falls is then not
  expanded again and again along all of its edges.

The driver sees two counts per round.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import drop_table, owned_tables, shuffle_partitions, table_path, write_table

# Delta tables side by side before they are merged.
MAX_DELTAS = 8
# Edges from which weighted searches are split into buckets of distances; below,
# the fixed cost of the additional rounds exceeds that of repeated expansions.
BUCKET_EDGES = 50_000_000
# Chains are contracted if at least one node in so many is inside one.
CHAIN_SHARE = 8


def _checked_edges(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """``src, dst, length``; a null, NaN or negative length fails the job, also
    where only the ends are used: the check is part of the column ``src``."""
    length = F.col("length")
    bad = length.isNull() | F.isnan(length.cast("double")) | (length < F.lit(0.0))
    failure = F.raise_error(F.lit("edge lengths must be numbers >= 0 (negative edge length, NaN or null found)"))
    return edges.select(F.when(bad, failure).otherwise(F.col(src)).alias("src"),
                        F.col(dst).alias("dst"), length.alias("length"))


def _contract(edges: DataFrame, inner: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``edges`` (``src, dst, length, hops, via``) without the nodes of ``inner``
    (one edge in, one out), and ``links``: ``node, ptr, length, hops, via`` of each
    inner node, its way from the first node before it that is none.

    Pointer doubling: in round r a link spans 2**r edges. What still points to an
    inner node after log2 of their number lies on a cycle that nothing enters."""
    spark = edges.sparkSession
    inside = inner.select(F.col("node").alias("dst"))
    links, path = write_table(
        edges.join(inside, "dst", "left_semi")
        .select(F.col("dst").alias("node"), F.col("src").alias("ptr"), "length", "hops", "via"), "chains")
    rounds = math.ceil(math.log2(max(2, links.count()))) + 1
    for _ in range(rounds):
        ahead = links.select(F.col("node").alias("ptr"), F.col("ptr").alias("ptr2"),
                             F.col("length").alias("length2"), F.col("hops").alias("hops2"))
        on = F.col("ptr2").isNotNull()
        nxt, nxt_path = write_table(
            links.join(ahead, "ptr", "left").select(
                "node", F.coalesce("ptr2", "ptr").alias("ptr"),
                F.when(on, F.col("length2") + F.col("length")).otherwise(F.col("length")).alias("length"),
                F.when(on, F.col("hops2") + F.col("hops")).otherwise(F.col("hops")).alias("hops"),
                "via", on.alias("moved")), "chains")
        drop_table(spark, path)
        links, path = nxt.drop("moved"), nxt_path
        if not nxt.where("moved").limit(1).count():
            break
    links = links.join(inner.withColumnRenamed("node", "ptr"), "ptr", "left_anti")
    outer = edges.join(inside, "dst", "left_anti")
    ends = links.select(F.col("node").alias("src"), F.col("ptr").alias("first"),
                        F.col("length").alias("before"), F.col("hops").alias("hops_before"))
    plain = outer.join(inner.withColumnRenamed("node", "src"), "src", "left_anti")
    chains = (outer.join(ends, "src").where(F.col("first") != F.col("dst"))
              .select(F.col("first").alias("src"), "dst", (F.col("before") + F.col("length")).alias("length"),
                      (F.col("hops_before") + F.col("hops")).alias("hops"), "via"))
    best = (plain.unionByName(chains).groupBy("src", "dst")
            .agg(F.min(F.struct("length", "hops", "via")).alias("e")).select("src", "dst", "e.*"))
    return best, links


class _Adjacency:
    """The edges to expand along, the hubs among them and the contracted chains."""

    def __init__(self, edges: DataFrame, origin: int, reverse: bool, weighted: bool):
        src, dst = ("to_node", "from_node") if reverse else ("from_node", "to_node")
        e = _checked_edges(edges, src, dst)
        e = (e.groupBy("src", "dst").agg(F.min("length").alias("length")) if weighted
             else e.select("src", "dst", F.lit(0.0).alias("length")).distinct())
        self.spark, self.width = edges.sparkSession, shuffle_partitions(edges.sparkSession)
        whole, _ = write_table(e, "edges")
        degrees, _ = write_table(self._degrees(whole), "degrees")
        is_origin = F.col("node") == F.lit(origin)
        inside = (F.col("ins") == 1) & (F.col("outs") == 1) & ~is_origin
        nodes, inner, known, size = degrees.agg(
            F.count(F.lit(1)), F.count_if(inside), F.count_if(is_origin), F.sum("outs")).first()
        # a loop never shortens a way
        e = whole.where(F.col("src") != F.col("dst")).select(
            "src", "dst", "length", F.lit(1).alias("hops"), F.col("src").alias("via"))
        self.known, self.size, self.links = known > 0, size or 0, None
        if inner * CHAIN_SHARE >= max(nodes, 1):
            e, links = _contract(e, degrees.where(inside).select("node"))
            (e, _), (self.links, _) = write_table(e, "contracted"), write_table(links, "links")
            degrees, _ = write_table(self._degrees(e), "degrees")
            self.size = e.count()
        share = F.lit(max(1.0, self.size / (4.0 * self.width)))
        # fewer than 4 * width rows by counting: each has over a 4P-th of the edges
        self.hubs, _ = write_table(
            degrees.where(F.col("outs") > share)
            .select(F.col("node").alias("src"), F.ceil(F.col("outs") / share).cast("int").alias("salts")), "hubs")
        self.edges = e
        if self.links is None:
            e = e.drop("hops", "via")
        salt = F.pmod(F.xxhash64("dst"), F.coalesce("salts", F.lit(1))).cast("int")
        self.salted = (
            e.join(F.broadcast(self.hubs), "src", "left").withColumn("salt", salt).drop("salts")
            .repartition(self.width, "src", "salt").sortWithinPartitions("src", "salt").persist())

    @staticmethod
    def _degrees(e: DataFrame) -> DataFrame:
        """``node, outs, ins`` of every end of an edge; loops count as none."""
        one, none = (F.col("src") != F.col("dst")).cast("long"), F.lit(0).cast("long")
        ends = e.select(F.col("src").alias("node"), one.alias("outs"), none.alias("ins")).unionByName(
            e.select(F.col("dst").alias("node"), none.alias("outs"), one.alias("ins")))
        return ends.groupBy("node").agg(F.sum("outs").alias("outs"), F.sum("ins").alias("ins"))

    def expand(self, frontier: DataFrame, only: Column | None = None) -> DataFrame:
        """``frontier`` (``src`` and state columns) joined to its out-edges, or to
        those for which ``only`` holds: ``src, dst, length, hops, via``."""
        salts = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - F.lit(1))
        spread = (frontier.join(F.broadcast(self.hubs), "src", "left")
                  .withColumn("salt", F.explode(salts)).drop("salts")
                  .repartition(self.width, "src", "salt"))
        # both sides are dealt alike; the merge join streams the cached side
        out = self.salted if only is None else self.salted.where(only)
        grown = spread.join(out.hint("merge"), ["src", "salt"]).drop("salt")
        return grown if self.links is not None else (
            grown.withColumn("hops", F.lit(1)).withColumn("via", F.col("src")))

    def close(self) -> None:
        self.salted.unpersist()


class _State:
    """``node, v`` rows: a bucketed base and the deltas since. ``v`` is a struct;
    the smallest of a node's rows is its value."""

    def __init__(self, adj: _Adjacency):
        self.spark, self.width = adj.spark, adj.width
        self.base: DataFrame | None = None
        self.base_name, self.base_path, self.base_rows = "", "", 0
        self.deltas: list[tuple[DataFrame, str, int]] = []
        self.busy: set[str] = set()         # paths that the search still reads

    def _all(self, tables: list[DataFrame]) -> DataFrame:
        rows = reduce(DataFrame.unionByName, [t.select("node", "v") for t in tables])
        return rows.groupBy("node").agg(F.min("v").alias("v"))

    def rows(self) -> DataFrame:
        tables = [d for d, _, _ in self.deltas] + ([self.base] if self.base is not None else [])
        return self._all(tables)

    def beside(self, cand: DataFrame) -> DataFrame:
        """``cand`` with ``now``, the present value of its nodes or null."""
        out = cand
        if self.deltas:
            out = out.join(self._all([d for d, _, _ in self.deltas]).withColumnRenamed("v", "newer"), "node", "left")
        if self.base is not None:
            out = out.join(self.base.select("node", F.col("v").alias("older")), "node", "left")
        names = [c for c in ("newer", "older") if c in out.columns]     # newer rows are the smaller ones
        return out.withColumn("now", F.coalesce(*names)).drop(*names) if names else (
            out.withColumn("now", F.lit(None).cast(cand.schema["v"].dataType)))

    def add(self, changed: DataFrame, *counts: Column) -> tuple[DataFrame, str, list[int]]:
        """Write the rows of a round and count them by ``counts``. They are the next
        one's frontier, so those before them are merged, if any."""
        delta, path = write_table(changed, "delta")
        if len(self.deltas) == MAX_DELTAS:
            self._merge(self.base is None or 4 * sum(n for _, _, n in self.deltas) >= self.base_rows)
        n, *counted = delta.agg(F.count(F.lit(1)), *(F.count_if(c) for c in counts)).first()
        self.deltas.append((delta, path, n))
        return delta, path, counted

    def _merge(self, whole: bool) -> None:
        """All deltas into one, or with the base into a new base."""
        old = [path for _, path, _ in self.deltas]
        if whole:
            path = table_path(self.spark, "base")
            name = f"tessera_state_{uuid.uuid4().hex}"
            (self.rows().write.bucketBy(self.width, "node").sortBy("node")
             .option("path", path).saveAsTable(name))
            self._drop_base()
            self.base, self.base_name, self.base_path = self.spark.table(name), name, path
            self.base_rows += sum(n for _, _, n in self.deltas)       # at most
            self.deltas = []
        else:
            one, path = write_table(self._all([d for d, _, _ in self.deltas]), "delta")
            self.deltas = [(one, path, sum(n for _, _, n in self.deltas))]
        for path in old:
            if path not in self.busy:
                drop_table(self.spark, path)

    def _drop_base(self) -> None:
        if self.base is not None:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.base_name}")
            drop_table(self.spark, self.base_path)

    def close(self) -> None:
        self._drop_base()
        self.base = None


class _Search(NamedTuple):
    """What a search keeps for a node, as a struct ``v`` whose first field grows
    along a way: the origin's value, the value along an edge (from ``v, src,
    length, hops, via``), whether the change of ``now`` to ``v`` matters to the nodes behind."""

    start: Column
    along: Column
    matters: Column


def _fixpoint(adj: _Adjacency, state: _State, origin: int, search: _Search, delta: float,
              max_rounds: int | None, seen: Callable[[DataFrame], None] | None) -> None:
    """Fill ``state`` with the values of all nodes that can be reached. Lengths are
    at least 0, so every graph ends; ``max_rounds`` is an optional guard. ``seen``
    is shown the rows that each round expands."""
    spark = adj.spark
    first = spark.range(1).select(F.lit(origin).cast("long").alias("node"), search.start.alias("v"))
    dist = F.col("v")[first.schema["v"].dataType[0].name]
    limit, rounds = delta, 0
    bucketed = math.isfinite(delta)
    near, near_path, (moved, waiting) = state.add(
        first.withColumn("moved", F.lit(True)), F.col("moved"), ~F.col("moved"))
    settled: list[tuple[DataFrame, str]] = []
    far: list[tuple[DataFrame, str]] = []

    def reached(table: DataFrame) -> DataFrame:
        rows = table.where("moved")
        return rows.where(dist < F.lit(limit)) if bucketed else rows

    def relax(front: DataFrame, only: Column | None) -> tuple[DataFrame, str, list[int]]:
        nonlocal rounds
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError(f"graph iteration did not converge in {max_rounds} rounds")
        rounds += 1
        front = front.select(F.col("node").alias("src"), "v")
        if seen:
            seen(adj.expand(front, only))
        cand = (adj.expand(front, only).withColumn("along", search.along)
                .groupBy(F.col("dst").alias("node")).agg(F.min("along").alias("v")))
        better = F.col("now").isNull() | (F.col("v") < F.col("now"))
        return state.add(state.beside(cand).where(better).select(
            "node", "v", (F.col("now").isNull() | search.matters).alias("moved")), *kinds())

    def kinds() -> tuple[Column, Column]:
        """Rows to expand in this bucket, and rows for later ones."""
        if not bucketed:
            return F.col("moved"), F.lit(False)
        return F.col("moved") & (dist < F.lit(limit)), F.col("moved") & (dist >= F.lit(limit))

    def smallest(tables: list[tuple[DataFrame, str]], which: Callable[[DataFrame], DataFrame]) -> DataFrame:
        rows = reduce(DataFrame.unionByName, [which(t).select("node", "v") for t, _ in tables])
        return rows.groupBy("node").agg(F.min("v").alias("v"))

    def release(tables: list[tuple[DataFrame, str]]) -> None:
        live = {p for _, p, _ in state.deltas}
        for _, path in tables:
            state.busy.discard(path)
            if path not in live:
                drop_table(spark, path)

    light = F.col("length") <= F.lit(delta) if bucketed else None
    while True:
        if bucketed and waiting:
            far.append((near, near_path))
            state.busy.add(near_path)
        if moved:
            if bucketed:
                settled.append((near, near_path))
                state.busy.add(near_path)
            near, near_path, (moved, waiting) = relax(reached(near), light)
            continue
        if settled:
            # the bucket is settled: its longer edges, once for each node
            done, settled = settled, []
            near, near_path, (moved, waiting) = relax(smallest(done, reached), ~light)
            late = {p for _, p in far}
            release([t for t in done if t[1] not in late])
            continue
        if not far:
            return
        # the next bucket: rows that waited and are still their node's value
        waited = smallest(far, lambda t: t.where(F.col("moved") & (dist >= F.lit(limit))))
        near, near_path = write_table(state.beside(waited).where(F.col("v") == F.col("now")).select(
            "node", "v", F.lit(True).alias("moved")), "far")
        state.busy.add(near_path)
        release(far)
        far = []
        least = near.agg(F.min(dist)).first()[0]
        if least is None:
            drop_table(spark, near_path)
            return
        limit = max((math.floor(least / delta) + 1) * delta, math.nextafter(least, math.inf))
        moved, waiting = near.agg(*(F.count_if(c) for c in kinds())).first()


def _run(edges: DataFrame, origin: int, reverse: bool, weighted: bool, search: _Search,
         max_rounds: int | None, delta: float | None = math.inf,
         seen: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """The final ``node, v``; ``delta`` None: by the number of edges."""
    with owned_tables(edges.sparkSession) as keep:
        adj = _Adjacency(edges, origin, reverse, weighted)
        state = _State(adj)
        try:
            none = adj.spark.range(0).select(F.col("id").alias("node"), search.start.alias("v"))
            if not adj.known:
                return keep(none, "state")
            if delta is None:
                mean = adj.edges.agg(F.avg("length")).first()[0] if adj.size >= BUCKET_EDGES else None
                delta = mean or math.inf
            _fixpoint(adj, state, origin, search, delta, max_rounds, seen)
            values = state.rows()
            if adj.links is not None:
                # an inner node of a chain: its first node's value, and the way from there
                inner = (values.withColumnRenamed("node", "ptr").join(adj.links, "ptr")
                         .withColumn("src", F.col("ptr")).select("node", search.along.alias("v")))
                values = values.unionByName(inner)
            return keep(values, "state")
        finally:
            state.close()
            adj.close()


def reachable_nodes(edges: DataFrame, source: int, max_rounds: int | None = None) -> DataFrame:
    """``node, level``: nodes reachable from ``source`` (itself at level 0)
    with their BFS depth. Without contracted chains each node is expanded once."""
    search = _Search(
        F.struct(F.lit(0).alias("level")),
        F.struct((F.col("v")["level"] + F.col("hops")).alias("level")),
        F.lit(True))
    return _run(edges, source, False, False, search, max_rounds).select("node", "v.level")


def reachable_count(edges: DataFrame, source: int,
                    max_rounds: int | None = None) -> DataFrame:
    """One row, ``reachable``: nodes reachable from ``source``, not counting
    the source itself; 0 for a source that is not in the graph."""
    reached = reachable_nodes(edges, source, max_rounds)
    return reached.agg(
        F.greatest(F.count(F.lit(1)) - F.lit(1), F.lit(0)).cast("bigint").alias("reachable"))


def _distances(edges: DataFrame, origin: int, reverse: bool, max_rounds: int | None,
               delta: float | None, seen: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """``node, distance`` from ``origin`` along the edges (or against them)."""
    search = _Search(
        F.struct(F.lit(0.0).alias("dist")),
        F.struct((F.col("v")["dist"] + F.col("length")).alias("dist")),
        F.lit(True))
    return _run(edges, origin, reverse, True, search, max_rounds, delta, seen).select(
        "node", F.col("v.dist").alias("distance"))


def shortest_from_source(edges: DataFrame, source: int, max_rounds: int | None = None,
                         delta: float | None = None) -> DataFrame:
    """``node, distance``: shortest distance from ``source`` to every node it
    reaches (itself 0.0). Unreached nodes and an absent source give no row.

    ``delta``: width of the buckets of distances, ``math.inf`` for none, None for
    the mean edge length on graphs of over :data:`BUCKET_EDGES` edges. Along a
    contracted chain lengths are added in pairs, so sums of fractions may round
    otherwise than from end to end."""
    return _distances(edges, source, False, max_rounds, delta)


def _to_target_state(edges: DataFrame, target: int, max_rounds: int | None,
                     delta: float | None) -> DataFrame:
    """``node, dist, hops, next_hop`` for every node that reaches ``target``.

    Order of paths: distance, then number of edges, then next hop id (so a
    route is the numerically smallest among the shortest ones with fewest
    edges). A node whose (dist, hops) improves is expanded again; one
    where only the next hop improves is not (its predecessors' candidates
    are unchanged).
    """
    v, now = F.col("v"), F.col("now")
    search = _Search(
        F.struct(F.lit(0.0).alias("dist"), F.lit(0).alias("hops"), F.lit(None).cast("long").alias("next_hop")),
        F.struct((v["dist"] + F.col("length")).alias("dist"), (v["hops"] + F.col("hops")).alias("hops"),
                 F.col("via").cast("long").alias("next_hop")),
        (v["dist"] != now["dist"]) | (v["hops"] != now["hops"]))
    return _run(edges, target, True, True, search, max_rounds, delta).select("node", "v.*")


def shortest_to_target(edges: DataFrame, target: int, max_rounds: int | None = None,
                       delta: float | None = None) -> DataFrame:
    """``node, distance``: shortest distance from every node to ``target``
    (target itself 0.0). Nodes that cannot reach it, and an absent target,
    give no row. Distances only, so the iteration runs against the edge
    direction without the hop/next-hop tie state of the route job. ``delta`` as
    in :func:`shortest_from_source`."""
    return _distances(edges, target, True, max_rounds, delta)


def _double(links: DataFrame) -> DataFrame:
    """One round of pointer doubling over ``node, distance, path, ptr``: rows
    with a pointer append the path of the row they point to and take over its
    pointer. Finished rows (no pointer) do not enter the join as such; they
    are only looked up, and kept beside it."""
    ahead = links.select(F.col("node").alias("ptr"), F.col("path").alias("p2"),
                         F.col("ptr").alias("ptr2"))
    moved = links.where(F.col("ptr").isNotNull()).join(ahead, "ptr").select(
        "node", "distance", F.concat("path", "p2").alias("path"), F.col("ptr2").alias("ptr"))
    return links.where(F.col("ptr").isNull()).unionByName(moved)


def shortest_routes_to_target(edges: DataFrame, target: int, max_rounds: int | None = None,
                              delta: float | None = None) -> DataFrame:
    """``node, distance, route`` with ``route`` the node ids ``a->b->...->target``
    of the chosen shortest path (ties: fewest edges, then smallest next hop).
    ``delta`` as in :func:`shortest_from_source`.

    Routes are assembled by pointer doubling over the ``next_hop`` links:
    after round r every row holds the first 2^r nodes of its route, so
    ceil(log2(longest route)) rounds suffice; each is one join on ``node`` of
    the unfinished rows, both sides read from written tables.
    """
    spark = edges.sparkSession
    with owned_tables(spark) as keep:
        state = _to_target_state(edges, target, max_rounds, delta)
        links, path = write_table(state.select(
            "node", F.col("dist").alias("distance"), F.array(F.col("node")).alias("path"),
            F.col("next_hop").alias("ptr")), "links")
        while links.where(F.col("ptr").isNotNull()).limit(1).count():
            nxt, nxt_path = write_table(_double(links), "links")
            drop_table(spark, path)
            links, path = nxt, nxt_path
        route = F.array_join(F.transform("path", lambda x: x.cast("string")), "->")
        return keep(links.select("node", "distance", route.alias("route")), "routes")
