"""Plan-shape and skew checks for the properties the jobs rely on at scale."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.operators import paths as P
from tessera.operators import setsim as J
from tessera.session import ensure_checkpoint_dir, materialize

SF = "/root/testdata/sf0.001"
# Adaptive execution as on data beyond its default byte limits, without broadcasts.
BIG = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@contextmanager
def conf(spark, settings):
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in settings:
            spark.conf.unset(k)


def rows_per_task(df):
    """Rows in each task that makes ``df`` (its last stage, before any shuffle);
    all columns are used."""
    used = df.select(F.spark_partition_id().alias("p"), F.xxhash64("*").alias("h"))
    return [r.n for r in used.groupBy("p").agg(F.count("h").alias("n"), F.max("h")).collect()]


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    plan = executed(entry.queries()["avg_in_length"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas == ["l_partkey:bigint,l_quantity:double"]
    assert "partial_avg" in plan


def test_tokenizer_stays_codegen_friendly(spark):
    plan = executed(entry.queries()["word_count_normalized"](spark, SF))
    assert "lambdafunction" not in plan
    assert "partial_count" in plan


def test_adjacency_reads_and_shuffles_its_edges_once(spark):
    plan = executed(entry.queries()["reverse_adjacency"](spark, SF)).split("Initial Plan")[-1]
    # once for the lists; the sources alone again, a row per node and task
    assert plan.count("ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity") == 1
    assert plan.count("ReadSchema: struct<l_partkey:bigint>") == 1
    assert "keys=[node" in plan and "partial_collect_set" in plan


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_token_is_split(spark, how):
    # one token in every record
    pairs = materialize(spark.range(120_000).select(
        F.col("id").alias("rid"), F.explode(F.array(F.lit("hot"), F.concat(F.lit("t"), F.col("id") % 5000))).alias("token")))
    with conf(spark, BIG):
        tasks = rows_per_task(J._frequency_join(pairs, "token", how))
    assert sum(tasks) == 240_000
    assert max(tasks) < 40_000      # unsplit, one task has more than 120,000


def test_hot_record_is_split_in_the_verification(spark):
    # record 0 in 100,000 candidate pairs
    records = materialize(spark.range(20_000).select(
        F.col("id").alias("rid"), F.array(F.col("id").cast("string")).alias("toks")))
    cand = materialize(spark.range(100_000).select(
        F.lit(0).cast("long").alias("rid_a"), (F.pmod(F.xxhash64("id"), F.lit(19_999)) + 1).alias("rid_b")))
    with conf(spark, BIG):
        ra = records.select(F.col("rid").alias("rid_a"), F.col("toks").alias("ta"))
        tasks = rows_per_task(cand.join(ra, "rid_a"))
    assert sum(tasks) == 100_000
    assert max(tasks) < 30_000


def test_hub_is_split_in_every_round(spark):
    # node 0 leads to 40,000 nodes; the others form a chain into it
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = spark.range(40_000).select(
        F.lit(0).alias("from_node"), (F.col("id") + 10).alias("to_node"), F.lit(1.0).alias("length")
    ).unionByName(spark.range(5).select(
        (F.col("id") + 1).alias("from_node"), F.col("id").alias("to_node"), F.lit(1.0).alias("length")))
    adj = P._Adjacency(edges, 5, reverse=False, weighted=True)
    try:
        assert [r.src for r in adj.hubs.collect()] == [0]
        tasks = rows_per_task(adj.salted)
        assert sum(tasks) == 40_005 and max(tasks) < 4 * 40_005 / width
        frontier = materialize(spark.range(2).select(F.col("id").alias("src"), F.lit(0.0).alias("dist")))
        grown = adj.expand(frontier)
        tasks = rows_per_task(grown)
        assert sum(tasks) == 40_001 and max(tasks) < 4 * 40_001 / width
        # only the frontier is shuffled and sorted: the cached edges are read
        # as they lie
        above = executed(grown).split("InMemoryRelation")[0]
        assert "SortMergeJoin" in above and "InMemoryTableScan" in above
        assert len(re.findall("(?<!Broadcast)Exchange hashpartitioning", above)) == 1
        assert len(re.findall(r"\bSort \[", above)) == 1
    finally:
        adj.close()


def test_finished_routes_stay_out_of_the_join(spark):
    links = spark.createDataFrame(
        [(0, 0.0, [0], None)] + [(i, float(i), [i], i - 1) for i in range(1, 6)]
        + [(i, 1.0, [i], None) for i in range(100, 200)],
        "node long, distance double, path array<long>, ptr long")
    out = {r.node: (r.path, r.ptr) for r in P._double(links).collect()}
    assert out[3] == ([3, 2], 1) and out[1] == ([1, 0], None) and len(out) == 106
    plan = executed(P._double(links)).split("Initial Plan")[-1]
    assert "isnotnull(ptr" in plan


def test_superseded_states_are_deleted(spark):
    import os
    from conftest import E2, EDGE_DDL
    base = ensure_checkpoint_dir(spark).removeprefix("file:") + "/tables"
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    out = P.shortest_from_source(spark.createDataFrame(E2, EDGE_DDL), 0)
    left = set(os.listdir(base)) - before
    assert len(left) == 1 and next(iter(left)).startswith("state-")
    assert out.count() == 5


@pytest.mark.parametrize("name,kept", [
    ("set_similarity_join", {"pairs-out"}), ("sp_routes_to_target", {"routes"}),
    ("prefix_index", {"prefix", "hot-keys", "ranges"}), ("reverse_adjacency", {"hot-keys", "ranges"})])
def test_only_what_the_result_reads_remains(spark, name, kept):
    import os
    base = ensure_checkpoint_dir(spark).removeprefix("file:") + "/tables"
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    out = entry.queries()[name](spark, SF)
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(base)) - before}
    assert left <= kept, left
    assert out.count() >= 1


def test_cluster_without_checkpoint_folder_is_an_error(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
