"""The driver's parquet tables and the derived inputs the jobs run on.

Every view reads whole tables; nothing is sampled or capped. Column pruning
reaches the parquet scan (each view selects only the columns it needs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import text_lines, whitespace_words


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def edges_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier -> part edges weighted by quantity, one per lineitem."""
    li = load_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("from_node"),
        F.col("l_partkey").alias("to_node"),
        F.col("l_quantity").alias("length"),
    )


def edges_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directed graph in one id space (part keys): every lineitem is an edge
    from its part to ``orderkey mod |part|``, weighted by quantity.

    ``|part|`` is a scalar subquery, evaluated once by Spark and inlined.
    """
    li = load_table(spark, sf_dir, "lineitem")
    n_parts = load_table(spark, sf_dir, "part").select(F.count(F.lit(1))).scalar()
    return li.select(
        F.col("l_partkey").alias("from_node"),
        (F.col("l_orderkey") % n_parts).alias("to_node"),
        F.col("l_quantity").alias("length"),
    )


def sets_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One set record per order: the part keys of its lineitems, as strings
    (repeats kept; the set-similarity operators make tokens distinct)."""
    li = load_table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("rid")).agg(
        F.collect_list(F.col("l_partkey").cast("string")).alias("tokens"))


def sets_orders_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records in long form ``(rid, token)``, without regrouping."""
    li = load_table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("rid"),
                     F.col("l_partkey").cast("string").alias("token"))


def sets_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One set record per document: its whitespace-separated words."""
    docs = load_table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("rid"), whitespace_words(F.col("text")).alias("tokens"))


def lines_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document (split on newline, empty lines kept)."""
    docs = load_table(spark, sf_dir, "documents")
    return docs.select(F.explode(text_lines(F.col("text"))).alias("value"))
