"""Readers for the reference's text formats (edge lists, set records, lines)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EDGE_SCHEMA = T.StructType([
    T.StructField("edge_id", T.LongType(), False),
    T.StructField("from_node", T.LongType(), False),
    T.StructField("to_node", T.LongType(), False),
    T.StructField("length", T.DoubleType(), False),
])


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """``edge_id from to length`` lines, one space apart.

    Blank lines are skipped by the CSV source; a short or non-numeric line
    fails the job (FAILFAST, with this reader's column pruning off so that
    every field is parsed). So does an empty field, which the CSV source reads
    as null: the check is part of the expressions that give the columns.
    Parallel file splits, schema on read, nothing inferred.
    """
    lines = (
        spark.read.schema(EDGE_SCHEMA)
        .option("sep", " ")
        .option("mode", "FAILFAST")
        .option("columnPruning", "false")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "true")
        .csv(path)
    )
    gap = reduce(or_, (F.col(f.name).isNull() for f in EDGE_SCHEMA.fields))
    return lines.select(*(
        F.when(gap, F.raise_error(F.lit("empty field in an edge line"))).otherwise(F.col(f.name))
        .alias(f.name) for f in EDGE_SCHEMA.fields))


def read_sets(spark: SparkSession, path: str) -> DataFrame:
    """``rid tok tok ...`` lines -> ``rid LONG, tokens ARRAY<STRING>``.

    Trailing spaces and empty tokens are dropped; blank lines are skipped.
    Tokens are kept as written (duplicates are the operators' business).
    """
    parts = F.split(F.trim(F.col("value"), F.lit(" ")), " ")
    return (
        spark.read.text(path)
        .where(F.trim(F.col("value"), F.lit(" ")) != F.lit(""))
        .select(
            F.element_at(parts, 1).cast("long").alias("rid"),
            F.array_remove(F.slice(parts, 2, F.size(parts)), "").alias("tokens"),
        )
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Plain text, one row per line (column ``value``)."""
    return spark.read.text(path)
