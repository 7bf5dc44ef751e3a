"""Mixing sources to target weights by pivotal dependent rounding.

``source_targets`` sets how many words every source should give. A document of
source s then gets ``target_s / size_s`` fractional copies, between 0 and 3:
the whole part is taken, the fractional part is rounded by the pivotal method.
Two fractional probabilities meet; mass is moved from one to the other until
one of them is 0 or 1, upwards or downwards at random with odds that keep both
expectations. Mass is measured in *words* (``x_i += m / size_i``,
``x_j -= m / size_j``), so each meeting also keeps the words of the source
exactly.

The meetings form a reduction tree: ``LEAVES`` leaves per source (documents
dealt by their hash, so a hot source fills many tasks), each a chain in one
streaming pass over sorted rows; the undecided document of every leaf goes on to
the next level, ``FAN_IN`` to a group, up to one group per source. Of two documents
the one with less room is decided, so it may be a large one that is left there.

Therefore a *reserve* stays out of the tree: of each source and size class (sizes
from a power of two to the next) about ``RESERVE`` documents, by their hash.
What the tree leaves is rounded by its own probability, and the reserve makes up
for it: its classes are taken from the largest to the smallest, each time with the
probability that the words still to be taken are of those still open, each
class by the pivotal method, its last document by its own probability. The words
that a class misses are a fair game, so the probabilities of the smaller ones keep
their expectation, and a source ends within about the size of a document of its
smallest class. (If the words still to be taken are below none or above all of
the open ones, the probability is cut at 0 or 1: then a difference stays, and
the few smallest documents do not keep their expectation quite.)

Random numbers are hashes of the seed and the document, and neither tree nor
reserve depends on the number of partitions or tasks, so reruns agree.

Defined results: a null text has size 0; documents of size 0 take 0 words;
null sources are one source, last in order; null ids and repeated rows are rows
like any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import word_count
from tessera.session import materialize, owned_tables

WEIGHTS = (1, 2, 3)       # by code point order of the source, repeating
MAX_COPIES = 3
LEAVES = 4096             # leaves of a source's tree
FAN_IN = 64               # undecided documents that meet in a group above
RESERVE = 32              # documents of a source and size class that settle the rest
SEED = 17


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, source_size, target`` of ``source, size`` rows.

    Targets share the total by weight; one that would pass ``max_copies`` times
    its source's size stops there and the excess is shared by the others, again
    by weight. In the order of ``limit / weight`` the first sources stop and
    the rest get ``weight * level``; the level is found from running sums."""
    totals = materialize(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    rank = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)),
                     (F.pmod(F.row_number().over(rank) - 1, F.lit(len(weights))) + 1).cast("int"))
    limit = F.col("source_size").cast("double") * float(max_copies)
    ranked = totals.select("source", "source_size", w.alias("w"), limit.alias("limit"))
    every = Window.partitionBy()
    order = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # the level at which all from this row on share what the rows before leave
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
             / F.sum("w").over(rest))
    shared = ranked.withColumn("level", level)
    # from that row on levels only fall: the first is the largest
    free = F.max(F.when(F.col("level") * F.col("w") <= F.col("limit"), F.col("level"))).over(every)
    return shared.withColumn("free", free).select(
        "source", "source_size",
        F.when(F.col("free").isNull(), F.col("limit"))
        .otherwise(F.least("limit", F.col("w") * F.col("free"))).alias("target"))


def _uniform(h: np.ndarray, level: int) -> np.ndarray:
    """Numbers in (0, 1) from row hashes: a finalising mix of 64 bits."""
    with np.errstate(over="ignore"):
        x = h.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53


EPS = 1e-9


def meet(p: float, size_p: int, q: float, size_q: int, u: float) -> tuple[float, float]:
    """One meeting of two undecided documents; one of the results is 0 or 1."""
    up = min((1.0 - p) * size_p, q * size_q)      # words that p can gain from q
    down = min(p * size_p, (1.0 - q) * size_q)    # words that q can gain from p
    move = up if u * (up + down) < down else -down
    p, q = p + move / size_p, q - move / size_q
    snap = [0.0 if x < EPS else 1.0 if x > 1.0 - EPS else x for x in (p, q)]
    return snap[0], snap[1]


def _chains(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
    """Play every group's chain in a partition sorted by group. Columns:
    ``group, h, size, x`` first, others after them pass through. The survivor
    of a group is held until the group ends (it may be in a later batch)."""
    held: dict | None = None        # the undecided row: group, x, size, and its one-row batch

    def put(row: pa.RecordBatch, x: float) -> pa.RecordBatch:
        return row.set_column(3, "x", pa.array([x]))

    for batch in batches:
        group = batch.column(0).to_pylist()
        size = batch.column(2).to_pylist()
        x = batch.column(3).to_pylist()
        u = _uniform(batch.column(1).to_numpy(zero_copy_only=False), level)
        here: int | None = None     # index of the held row if it lies in this batch
        for i, (g, s, p) in enumerate(zip(group, size, x)):
            if held is not None and held["group"] != g:
                if here is None:
                    yield put(held["row"], held["x"])
                held, here = None, None
            if not EPS <= p <= 1.0 - EPS:
                continue
            if held is None:
                held, here = {"group": g, "x": p, "size": s}, i
                continue
            a, b = meet(held["x"], held["size"], p, s, u[i])
            if here is None and a in (0.0, 1.0):
                yield put(held["row"], a)
            elif here is not None:
                x[here] = a
            x[i] = b
            if a in (0.0, 1.0):
                held, here = ({"group": g, "x": b, "size": s}, i) if b not in (0.0, 1.0) else (None, None)
            else:
                held["x"] = a
        out = batch.set_column(3, "x", pa.array(x, pa.float64()))
        if here is not None:        # hold it back: it may meet the next batch
            held["row"] = out.slice(here, 1)
            keep = np.ones(len(group), dtype=bool)
            keep[here] = False
            out = out.filter(pa.array(keep))
        if out.num_rows:
            yield out
    if held is not None:
        yield put(held["row"], held["x"])


def _play(rows: DataFrame, level: int) -> DataFrame:
    """One level of the tree over ``group, h, size, x, ...`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _chains(batches, level)

    return (rows.repartition("group")
            .sortWithinPartitions("group", F.desc("size"), "h")
            .mapInArrow(run, rows.schema))


def settle(size: np.ndarray, x: np.ndarray, spare: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """0 or 1 for every document of a source's end: those that the tree left, and the
    reserve (``spare``), by size from the largest. ``u, v``: random numbers of each."""
    out = x.copy()
    for i in np.flatnonzero(~spare):
        out[i] = float(u[i] < x[i]) if EPS <= x[i] <= 1.0 - EPS else round(x[i])
    need = float(size @ x) - float(size[~spare] @ out[~spare])
    rest = float(size[spare].sum())
    classes = np.frexp(size.astype(np.float64))[1]
    for c in sorted(set(classes[spare].tolist()), reverse=True):
        members = np.flatnonzero(spare & (classes == c))
        p = min(max(need / rest, 0.0), 1.0)
        held, q = -1, 0.0               # the undecided one
        for i in members:
            if not EPS <= p <= 1.0 - EPS:
                out[i] = round(p)
            elif held < 0:
                held, q = i, p
            else:
                a, b = meet(q, int(size[held]), p, int(size[i]), u[i])
                out[held], out[i] = a, b
                held, q = (held, a) if a not in (0.0, 1.0) else (i, b) if b not in (0.0, 1.0) else (-1, 0.0)
        if held >= 0:
            out[held] = float(v[held] < q)
        need -= float(size[members] @ out[members])
        rest -= float(size[members].sum())
    return out


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by ``group``: every group settled. A group has one document of
    the tree and the reserve, so a bounded number in expectation."""
    held: list[pa.RecordBatch] = []

    def done(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        batch = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        h, size, x = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
        spare = batch.column(4).to_numpy(zero_copy_only=False).astype(bool)
        order = np.lexsort((h, -size))
        out = np.empty(len(x))
        out[order] = settle(size[order], x[order], spare[order], _uniform(h, 100)[order], _uniform(h, 101)[order])
        return batch.set_column(3, "x", pa.array(out))

    for batch in batches:
        group = batch.column(0).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        for s, e in zip(edges, edges[1:]):
            if e == s:
                continue
            if held and held[-1].column(0)[0].as_py() != group[s]:
                yield done(held)
                held = []
            held.append(batch.slice(s, e - s))
    if held:
        yield done(held)


def _open() -> Column:
    return F.col("x").between(EPS, 1.0 - EPS)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES,
        seed: int = SEED, leaves: int = LEAVES, fan_in: int = FAN_IN) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` of every row."""
    return _mixed(docs, weights, max_copies, seed, leaves, fan_in).drop("h", "source")


def mixed_texts(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES,
                seed: int = SEED, leaves: int = LEAVES, fan_in: int = FAN_IN) -> DataFrame:
    """The rows of ``docs`` that the mixture takes, with ``copies`` (instead of a column
    of that name, if any). Rows equal in id, source and text are one row here, with
    the copies of all of them. The texts are shuffled once, by the rows' hash, unless
    the table of copies is small."""
    mixed = _mixed(docs, weights, max_copies, seed, leaves, fan_in)
    copies = (mixed.groupBy("h", "doc_id", "source").agg(F.sum("copies").alias("n")).where(F.col("n") > 0)
              .select(F.col("h").alias("__h"), F.col("doc_id").alias("__doc_id"), F.col("source").alias("__source"),
                      F.col("n").alias("__copies")))
    columns = [c for c in docs.columns if c != "copies"]
    return (docs.withColumn("__key", row_hash(seed))
            .join(copies, (F.col("__key") == F.col("__h")) & F.col("doc_id").eqNullSafe(F.col("__doc_id"))
                  & F.col("source").eqNullSafe(F.col("__source")))
            .dropDuplicates(["__key", "doc_id", "source"])
            .select(*columns, F.col("__copies").alias("copies")))


def row_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"), F.col("text"))


def _mixed(docs: DataFrame, weights: tuple[int, ...], max_copies: int, seed: int, leaves: int,
           fan_in: int) -> DataFrame:
    """:func:`mix` with the rows' ``h, source``.

    Texts are only counted where they are read; what is shuffled are ids,
    sizes and hashes. A document that is undecided at a leaf appears again at
    the next level, so each level adds at most leaves / fan_in**level rows."""
    with owned_tables(docs.sparkSession) as keep:
        sized = materialize(docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"),
            row_hash(seed).alias("h")), "sizes")
        targets = materialize(source_targets(sized, weights, max_copies), "targets")
        share = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        whole = F.floor(share + EPS)
        rows = (
            sized.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
            .select(F.xxhash64(F.col("source").isNull(), F.col("source")).alias("key"),
                    "doc_id", "source", "h", "size", "source_size", "target", whole.alias("whole"),
                    F.greatest(F.lit(0.0), share - whole).alias("x"),
                    F.floor(F.log2(F.greatest("size", F.lit(1)))).cast("int").alias("class")))
        classes = materialize(rows.groupBy("key", "class").agg(F.count(F.lit(1)).alias("n"))
                              .select(F.col("key").alias("k"), F.col("class").alias("c"), "n"), "classes")
        drawn = (F.pmod(F.xxhash64("h", F.lit(-2)), F.lit(1 << 30)) + 0.5) / float(1 << 30)
        rows = materialize(
            rows.join(classes, (F.col("key") == F.col("k")) & (F.col("class") == F.col("c")))
            .withColumn("spare", _open() & (drawn * F.col("n") < F.lit(RESERVE))).drop("k", "c", "n", "class"), "rows")
        leaf = F.xxhash64(F.col("key"), F.pmod(F.xxhash64("h", F.lit(1)), F.lit(leaves)))
        columns = ["h", "size", "x", "spare", "key", "doc_id", "source", "source_size", "target", "whole"]
        done = []
        live = rows.where(~F.col("spare"))
        levels = ceil(log(leaves) / log(fan_in)) if leaves > 1 else 0
        for level in range(levels + 1):
            groups = max(1, ceil(leaves / fan_in ** level))
            group = leaf if level == 0 else F.xxhash64(
                F.col("key"), F.pmod(F.xxhash64("h", F.lit(level + 1)), F.lit(groups)))
            if level == levels:
                group = F.col("key")
            played = materialize(_play(live.select(group.alias("group"), *columns), level), "level")
            done.append(played.where(~_open()))
            live = played.where(_open())
        last = (live.drop("group").unionByName(rows.where("spare"))
                .select(F.col("key").alias("group"), *columns).repartition("group").sortWithinPartitions("group"))
        done.append(last.mapInArrow(_settled, last.schema))
        out = done[0]
        for d in done[1:]:
            out = out.unionByName(d)
        copies = F.col("whole") + F.round("x").cast("long")
        return keep(out.select("h", "source", "doc_id", "size", "source_size", "target",
                               (copies * F.col("size")).alias("taken"), copies.alias("copies")), "mixture")
