"""SimHash near-duplicates: fingerprints, BK-trees per shard, components.

A fingerprint has 64 bits; two texts are linked if theirs differ in at most
``RADIUS`` bits. Equal fingerprints are collapsed first, so copies cost one
row. The 64 bits are cut into ``BLOCKS`` = radius + 2 blocks: two fingerprints
within the radius agree on at least two whole blocks, so every pair of blocks
is a table, and a *shard* is what agrees on one pair of blocks. No link is
lost, and a shard holds about N / 2**25 fingerprints by chance.

Each shard is one group of rows in one task: a BK-tree is grown from it
(children keyed by their integer Hamming distance to the parent) and a search
follows only the edges ``d - radius .. d + radius``. A shard of more than
``SHARD_LIMIT`` fingerprints is cut by hash into pieces, and every pair of
pieces is a group of its own: one piece's tree, replicated to the tasks that
search it with the others' fingerprints. No tree or fingerprint table goes to
the driver; a task holds at most about two pieces. A group returns the edges of
its local spanning stars, not its pairs, and the components of all stars are
found by :mod:`tessera.llm.components`.

Defined results: a null text is empty; texts without words have fingerprint
zero and are linked like any other; repeated rows share a component; a null
``doc_id`` is linked too but never names a component of others; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import append_columns, raw_texts
from tessera.llm.components import connected_components
from tessera.session import materialize, owned_tables

SHINGLE = 3
RADIUS = 3
SEED = 42
SHARD_LIMIT = 2048

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash (unsigned) of a text: words of the text with A-Z lower
    cased, XXH64 of each shingle, a bit set where over half the hashes set it."""
    words = raw.lower().split()
    n = len(words)
    if n == 0:
        return 0
    flat = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(flat, SEED)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    m = n - shingle + 1
    hashes = np.fromiter((digest(flat[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:])),
                         dtype=np.uint64, count=m)
    octets = hashes.astype("<u8").view(np.uint8).reshape(m, 8)
    if m < 256:
        counts = np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0)
    else:
        counts = np.concatenate([np.bincount(octets[:, j], minlength=256) @ _BITS for j in range(8)])
    return int(np.packbits(counts * 2 > m, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` plus its fingerprint as a (signed) long."""
    at = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        prints = np.array([fingerprint(t, shingle) for t in raw_texts(batch.column(at))],
                          dtype=np.uint64)
        return [pa.array(prints.view(np.int64))]

    return append_columns(docs, run, [T.StructField(name, T.LongType())])


class BKTree:
    """Burkhard-Keller tree of integers under the Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        values, children = self.values, self.children
        values.append(value)
        children.append({})
        new = len(values) - 1
        at = 0
        while at != new:
            at = children[at].setdefault((values[at] ^ value).bit_count(), new)

    def search(self, value: int, radius: int) -> list[int]:
        """Indices of the values within ``radius`` of ``value``."""
        values, children = self.values, self.children
        found, todo = [], [0] if values else []
        while todo:
            at = todo.pop()
            d = (values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            if edges := children[at]:
                if len(edges) > 2 * radius + 1:
                    todo.extend(edges[k] for k in range(d - radius, d + radius + 1) if k in edges)
                else:
                    todo.extend(c for k, c in edges.items() if -radius <= k - d <= radius)
        return found


def _stars(tree_side: list[int], search_side: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """Edges ``(member, smallest of its local component)``. With no
    ``search_side`` the tree is searched by its own values as it grows."""
    tree = BKTree()
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    def link(a: int, b: int) -> None:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)

    if search_side is None:
        for v in tree_side:
            for i in tree.search(v, radius):
                link(v, tree.values[i])
            tree.add(v)
    else:
        for v in tree_side:
            tree.add(v)
        for v in search_side:
            for i in tree.search(v, radius):
                link(v, tree.values[i])
    return [(x, root(x)) for x in list(parent)]


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """``(piece, fp, one_piece)`` of every group of two or more in a partition
    sorted by ``shard, left, right``; a group may run over batches."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            cols = [np.concatenate(x) for x in zip(rest, cols, strict=True)]
        cut = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0)
                             | (np.diff(cols[2]) != 0)) + 1
        last = cut[-1] if len(cut) else 0
        starts = np.concatenate([[0], cut[:-1]]) if len(cut) else np.empty(0, np.int64)
        for s, e in zip(starts, cut):
            if e - s > 1:
                yield cols[3][s:e], cols[4][s:e], cols[1][s] == cols[2][s]
        rest = [c[last:] for c in cols]
    if rest is not None and len(rest[0]) > 1:
        yield rest[3], rest[4], rest[1][0] == rest[2][0]


def fingerprint_links(prints: DataFrame, radius: int = RADIUS,
                      shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """Edges ``a, b`` (star-shaped per shard) whose components are those of
    "differs in at most ``radius`` bits" over the distinct ``fp`` of ``prints``."""
    blocks = radius + 2
    edge = [round(64 * i / blocks) for i in range(blocks + 1)]
    part = [F.shiftrightunsigned(F.shiftleft("fp", 64 - edge[i + 1]), 64 - edge[i + 1] + edge[i])
            for i in range(blocks)]
    shard = F.array(*(F.xxhash64(F.lit(t), part[i], part[j])
                      for t, (i, j) in enumerate(combinations(range(blocks), 2))))
    rows = prints.select("fp", F.explode(shard).alias("shard"))
    # only shards with company go on; large ones are cut into pieces
    sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    sizes = materialize(sizes, "shards")
    pieces = F.ceil(F.col("n") / F.lit(shard_limit)).cast("int")
    piece = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("pieces")).cast("int")
    cells = (
        rows.join(sizes.select("shard", pieces.alias("pieces")), "shard")
        .withColumn("piece", piece)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .select("shard", F.least("piece", "other").alias("left"),
                F.greatest("piece", "other").alias("right"), "piece", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, fp, one in _sorted_groups(batches):
            unsigned = fp.astype(np.int64).view(np.uint64)
            if one:
                stars = _stars(unsigned.tolist(), None, radius)
            else:
                first = piece == piece.min()
                stars = _stars(unsigned[first].tolist(), unsigned[~first].tolist(), radius)
            if stars:
                ends = np.array(stars, dtype=np.uint64).view(np.int64).reshape(-1, 2)
                keep = ends[:, 0] != ends[:, 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ends[keep, 0]), pa.array(ends[keep, 1])], names=["a", "b"])

    return (cells.repartition("shard", "left", "right")
            .sortWithinPartitions("shard", "left", "right", "fp")
            .mapInArrow(run, "a long, b long"))


def fingerprint_components(prints: DataFrame, radius: int = RADIUS,
                           shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """``fp, label`` of every distinct ``fp``: equal labels, one component."""
    distinct = materialize(prints.select("fp").distinct(), "distinct")
    labels = connected_components(fingerprint_links(distinct, radius, shard_limit))
    return materialize(
        distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", F.coalesce("label", "fp").alias("label")), "labels")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                    shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs``;
    ``component_id`` is the smallest ``doc_id`` that can be reached."""
    with owned_tables(docs.sparkSession) as keep:
        prints = keep(with_fingerprint(docs.select("doc_id", "text"), "fp", shingle)
                      .select("doc_id", "fp"), "prints")
        labels = fingerprint_components(prints, radius, shard_limit)
        firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first")).join(labels, "fp")
        firsts = materialize(firsts, "firsts")
        names = firsts.groupBy("label").agg(F.min("first").alias("component_id"))
        names = keep(firsts.join(materialize(names, "names"), "label")
                     .select("fp", "component_id"), "components")
    return (prints.join(names, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    "component_id"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                         shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest
    ``doc_id`` (a null id last), of a repeated id the smallest row hash.

    The choice is made on fingerprints, ids and row hashes; the texts are
    shuffled once, by the row hash, to meet the chosen ones."""
    row = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"),
                    F.col("h"))
    with owned_tables(docs.sparkSession) as keep:
        prints = materialize(
            with_fingerprint(docs.select("doc_id", "text"), "fp", shingle)
            .select("doc_id", "fp", row.alias("h")), "prints")
        labels = fingerprint_components(prints, radius, shard_limit)
        firsts = materialize(prints.groupBy("fp").agg(F.min(rank).alias("first")), "firsts")
        chosen = keep(firsts.join(labels, "fp").groupBy("label")
                      .agg(F.min("first").alias("first"))
                      .select(F.col("first.h").alias("__sim_row")), "chosen")
    return (docs.withColumn("__sim_row", row).join(chosen, "__sim_row", "left_semi")
            .dropDuplicates(["__sim_row", "doc_id", "text"]).select(*docs.columns))
