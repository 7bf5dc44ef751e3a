"""Single-pass edge-list jobs: edge-length averages, node set, adjacency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.grouping import SEGMENT_ITEMS, collect_segments


def avg_in_length(edges: DataFrame) -> DataFrame:
    """Average length of the edges entering each node (``node, avg_length``).

    Nodes without incoming edges are absent. Partial sum/count per map task,
    one shuffle on the node key, final average.
    """
    return edges.groupBy(F.col("to_node").alias("node")).agg(
        F.avg("length").alias("avg_length"))


def avg_out_length(edges: DataFrame) -> DataFrame:
    """Average length of the edges leaving each node, ordered by the average
    descending, ties by node ascending (``node, avg_length``)."""
    return (
        edges.groupBy(F.col("from_node").alias("node"))
        .agg(F.avg("length").alias("avg_length"))
        .orderBy(F.desc("avg_length"), F.asc("node"))
    )


def graph_nodes(edges: DataFrame) -> DataFrame:
    """Every node that is an end of some edge (``node``)."""
    return (
        edges.select(F.col("from_node").alias("node"))
        .union(edges.select(F.col("to_node").alias("node")))
        .distinct()
    )


def reverse_adjacency(edges: DataFrame, segment_items: int = SEGMENT_ITEMS) -> DataFrame:
    """In-neighbours of every node: ``node, segment, neighbors`` where
    ``neighbors`` is a sorted ``array<struct<from_node, length>>`` of at most
    ``segment_items`` neighbours; a node's next ones are in its next segment.

    Exact duplicate edges appear once; parallel edges of another length are
    kept. Every node has a row for segment 0, which is empty if it has no
    incoming edges. One shuffle of the edges on the node; the nodes without
    incoming edges come from a distinct, a row per node and task.
    """
    into = edges.select(F.col("to_node").alias("node"),
                        F.struct(F.col("from_node"), F.col("length")).alias("item"))
    empty = F.lit(None).cast(into.schema["item"].dataType)
    sources = edges.select(F.col("from_node").alias("node")).distinct().withColumn("item", empty)
    return collect_segments(into.unionByName(sources), "node", "item", "neighbors", segment_items)


def adjacency_text(adjacency: DataFrame) -> DataFrame:
    """``node, segment, neighbors`` with the list as ``from:length,from:length``;
    lengths are printed in full."""
    rendered = F.array_join(
        F.transform("neighbors", lambda x: F.concat(
            x["from_node"].cast("string"), F.lit(":"), x["length"].cast("string"))),
        ",")
    return adjacency.select("node", "segment", rendered.alias("neighbors"))
