"""Connected components of an edge table, as rounds of DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import drop_table, write_table


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every end of an edge (``a, b``, any orderable
    type); ``label`` is the smallest node of the component.

    A round points every node to the smallest of its neighbours and itself, follows
    the pointers to their ends by doubling, and contracts the edges to these
    ends. Only nodes smaller than all their neighbours are ends, so a path, in
    whatever order its nodes are numbered, shrinks to less than half in each round,
    and a star in two rounds to a point. Pointers, labels and edges are written
    tables: lost executors cost one step, superseded ones are deleted, and both
    sides of every join are plain shuffles, so a hub is split by adaptive execution.
    The driver sees one count per step. Null ends and loops are ignored."""
    spark = edges.sparkSession
    ends = edges.where(F.col("a") != F.col("b")).select("a", "b")
    live, live_path = write_table(
        ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "cc-edges")
    state, path = None, ""
    while True:
        up, up_path = write_table(
            live.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
            .select("node", F.least("node", "m").alias("up")), "cc-up")
        while True:
            ahead = up.select(F.col("node").alias("up"), F.col("up").alias("end"))
            nxt, nxt_path = write_table(
                up.join(ahead, "up").select("node", F.col("end").alias("up"), (F.col("end") < F.col("up")).alias("moved")),
                "cc-up")
            drop_table(spark, up_path)
            up, up_path = nxt.select("node", "up"), nxt_path
            if not nxt.where("moved").limit(1).count():
                break
        if state is None:
            labels = up.withColumnRenamed("up", "label")
        else:
            labels = state.join(up.select(F.col("node").alias("label"), "up"), "label", "left").select(
                "node", F.coalesce("up", "label").alias("label"))
        nxt, nxt_path = write_table(labels, "cc-state")
        if state is not None:
            drop_table(spark, path)
        state, path = nxt, nxt_path
        a = up.select(F.col("node").alias("a"), F.col("up").alias("x"))
        b = up.select(F.col("node").alias("b"), F.col("up").alias("y"))
        nxt, nxt_path = write_table(
            live.join(a, "a").join(b, "b").where(F.col("x") != F.col("y"))
            .select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "cc-edges")
        drop_table(spark, live_path)
        drop_table(spark, up_path)
        live, live_path = nxt, nxt_path
        if not live.limit(1).count():
            drop_table(spark, live_path)
            return state
