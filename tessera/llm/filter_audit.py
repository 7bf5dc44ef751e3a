"""What filters do to each other, by decision diagrams of their failures.

1. *Masks.* Every text is read once and gives the failure bits of the filters
   that look at one text, and a SHA-256 that stands for the text. A text's
   smallest ``doc_id`` (a partial minimum, so copies cost a row per task) is met
   again on ``(text, doc_id)``, a key without hot values: who does not meet it
   is a later copy.
2. *Counts.* ``part, mask`` with the number of documents, good and toxic ones:
   at most ``2 ** filters`` rows a part, after a partial aggregate.
3. *Diagrams.* A part's counts become a decision diagram: a level for each filter,
   a pass and a fail child, equal subgraphs shared, and the counts of the documents
   below as the weight of each node. Plain changes (every permutation by swaps of
   neighbours) reorder it by adjacent level swaps, which touch two levels. In each
   order the path on which all filters pass has the steps: the weight of a fail
   child is what the filter removes there, that of the pass child what it keeps.

Conditions (texts whole, words ``[^\\x20\\x09-\\x0D]+``, case-sensitive): A under
``MIN_WORDS`` words; B distinct words under ``MIN_DISTINCT`` percent of the words; C
``[A-Z]`` over ``MAX_UPPER`` percent of the code points; D any of ``[#$%&*|]``; E
the text of a smaller ``doc_id``.

Defined results: a null text is empty; a null ``source`` is the part ``''``; a null
``doc_id`` is neither smaller nor larger than another; repeated rows count each and
are no copies of each other; of repeated labels one 1 is enough, null is 0; an empty
table has no parts; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, raw_texts
from tessera.session import materialize

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 50, 65, 5
SYMBOLS = b"#$%&*|"

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUATION = bytes(range(0x80, 0xC0))
Counts = tuple[int, int, int]


def text_failures(raw: bytes) -> int:
    """Failure bits of the filters A to D (bit 0 is A)."""
    words = raw.split()
    n, size = len(words), len(raw)
    upper = size - len(raw.translate(None, _UPPER))
    chars = size - (0 if raw.isascii() else size - len(raw.translate(None, _CONTINUATION)))
    return ((n < MIN_WORDS)
            | (100 * len(set(words)) < MIN_DISTINCT * n) << 1
            | (100 * upper > MAX_UPPER * chars) << 2
            | (len(raw.translate(None, SYMBOLS)) != size) << 3)


def failure_masks(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask`` of every row; bit i of ``mask``: filter i fails."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = raw_texts(batch.column(2))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1),
             pa.array([text_failures(t) for t in texts], pa.int32()),
             pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
            names=["doc_id", "part", "own", "text_key"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("source", F.lit("")).alias("part"), "text")
    own = materialize(map_batches(rows, run, "doc_id long, part string, own int, text_key binary"), "masks")
    first = (own.groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
             .where(F.col("doc_id").isNotNull()).withColumn("first", F.lit(1)))
    later = F.col("doc_id").isNotNull() & F.col("first").isNull()
    copy = F.lit(1 << FILTERS.index("E"))
    return own.join(first, ["text_key", "doc_id"], "left").select(
        "doc_id", "part", F.col("own").bitwiseOR(F.when(later, copy).otherwise(F.lit(0))).alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each mask, those labelled
    ``quality`` 1 and those labelled ``toxic`` 1."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    return (masks.select("doc_id", "part", "mask").join(known, "doc_id", "left")
            .groupBy("part", "mask").agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(F.coalesce("good", F.lit(0))).alias("good"),
                F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")))


class Node:
    """A node of a diagram: two children and the counts of the leaves below."""

    __slots__ = ("passed", "failed", "weight")

    def __init__(self, passed: "Node | None", failed: "Node | None", weight: Counts):
        self.passed, self.failed, self.weight = passed, failed, weight


class Diagram:
    """Count-weighted decision diagram of failure masks: one level a filter, in
    ``order``; leaves are the counts of a mask, and equal subgraphs are one."""

    def __init__(self, counts: dict[int, Counts], filters: int):
        self.order = list(range(filters))
        self.levels: list[dict[tuple[int, int], Node]] = [{} for _ in range(filters)]
        leaves: dict[Counts, Node] = {}

        def grow(level: int, mask: int) -> Node:
            if level == filters:
                weight = counts.get(mask, (0, 0, 0))
                return leaves.setdefault(weight, Node(None, None, weight))
            return self._node(self.levels[level], grow(level + 1, mask),
                              grow(level + 1, mask | 1 << level))

        self.root = grow(0, 0)

    @staticmethod
    def _node(level: dict[tuple[int, int], Node], passed: Node, failed: Node) -> Node:
        key = id(passed), id(failed)
        if key not in level:
            level[key] = Node(passed, failed, tuple(map(sum, zip(passed.weight, failed.weight))))
        return level[key]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next. The nodes of ``level``
        stay (what is above points to them) and get new children."""
        below: dict[tuple[int, int], Node] = {}
        nodes = list(self.levels[level].values())
        for node in nodes:
            a, b = node.passed, node.failed
            node.passed = self._node(below, a.passed, b.passed)
            node.failed = self._node(below, a.failed, b.failed)
        self.levels[level] = {(id(n.passed), id(n.failed)): n for n in nodes}
        self.levels[level + 1] = below
        order = self.order
        order[level], order[level + 1] = order[level + 1], order[level]

    def steps(self) -> Iterator[tuple[int, Counts, Counts]]:
        """``filter, removed, kept`` along the path on which all pass."""
        node = self.root
        for f in self.order:
            yield f, node.failed.weight, node.passed.weight
            node = node.passed


def plain_changes(n: int) -> list[int]:
    """Places to swap with their right neighbour so that all n! orders come once."""
    if n < 2:
        return []
    inner = plain_changes(n - 1)
    out: list[int] = []
    for turn, change in enumerate([*inner, None]):
        down = turn % 2 == 0        # the last element walks to the front, then back
        out += range(n - 2, -1, -1) if down else range(n - 1)
        if change is not None:
            out.append(change + 1 if down else change)
    return out


def order_report(counts: dict[int, Counts], names: str = FILTERS) -> list[tuple]:
    """``order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley`` of every order and step of one part."""
    diagram = Diagram(counts, len(names))
    runs = [(tuple(diagram.order), list(diagram.steps()))]
    for level in plain_changes(len(names)):
        diagram.swap(level)
        runs.append((tuple(diagram.order), list(diagram.steps())))
    failing, unique, shapley = {}, {}, dict.fromkeys(range(len(names)), 0)
    for _, steps in runs:
        failing[steps[0][0]] = steps[0][1][0]       # first: it removes all that fail it
        unique[steps[-1][0]] = steps[-1][1][0]      # last: what only it removes
        for f, removed, _ in steps:
            shapley[f] += removed[0]
    return [("".join(names[f] for f in order), i, kept[0], removed[0], failing[f] - removed[0], unique[f],
             removed[1], removed[2], shapley[f])
            for order, steps in runs for i, (f, removed, kept) in enumerate(steps, 1)]


_REPORT = [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
           *((name, pa.int64()) for name in ("kept", "removed", "redundant", "unique_fails", "good_lost",
                                             "toxic_lost", "shapley"))]


def interaction_report(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """Every order and step of every part, from ``part, mask, n, good, toxic``."""
    parts = counts.groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))   # at most 2 ** filters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = order_report({c["mask"]: (c["n"], c["good"], c["toxic"]) for c in cells}, names)
                columns = [[part] * len(rows), *zip(*rows)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, (_, t) in zip(columns, _REPORT)], names=[n for n, _ in _REPORT])

    return parts.mapInArrow(
        run, "part string, filter_order string, step int, kept long, removed long, redundant long, "
             "unique_fails long, good_lost long, toxic_lost long, shapley long")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """:func:`interaction_report` of the filters A to E over ``docs``."""
    return interaction_report(mask_counts(failure_masks(docs), labels))
