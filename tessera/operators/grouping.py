"""Segmented lists: values collected per key without ever building one
unbounded array, by one rule at every size.

The distinct values of a key, in their order, are numbered from 0, and segment i
holds the numbers ``i * width .. (i + 1) * width - 1``: a list is never longer
than ``width``, whatever the values (sparse ids, parallel edges), and no segment
but a key's last is shorter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import drop_table, materialize, shuffle_partitions, write_table

# Values per segment.
SEGMENT_ITEMS = 100_000


def segment_of(number: str, width: int) -> Column:
    """Column ``number`` (a long >= 0) ``div width``, without going over doubles."""
    return F.expr(f"`{number}` div {int(width)}")


def _numbered(rows: DataFrame, key: str, item: str) -> DataFrame:
    """``rows`` (distinct) and the place ``number`` of each item within its key.

    Distributed, so that a key may have any number of values: the rows are dealt
    out by ranges of ``(key, item)`` and written; a key's rows in a part follow
    those of its earlier parts, of which there are no more than partitions."""
    width = shuffle_partitions(rows.sparkSession)
    parts = materialize(rows.repartitionByRange(width, key, item)
                        .withColumn("part", F.spark_partition_id()), "ranges")
    sizes = parts.groupBy(key, "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(key).orderBy("part")
    offsets = sizes.select(key, "part", (F.sum("n").over(before) - F.col("n")).alias("offset"))
    inside = Window.partitionBy(key, "part").orderBy(item)
    return (parts.withColumn("place", F.row_number().over(inside))
            .join(offsets, [key, "part"])
            .select(key, item, (F.col("offset") + F.col("place") - F.lit(1)).alias("number")))


def collect_segments(rows: DataFrame, key: str, item: str, out: str,
                     width: int = SEGMENT_ITEMS) -> DataFrame:
    """``key, segment, out`` with ``out`` the sorted distinct ``item`` values of
    each segment of each key of ``rows`` (``key, item``); null items leave an empty
    list, in segment 0.

    Keys of up to ``width`` rows are one list each: a shuffle on the key after a
    partial collection in the map tasks. The rows of the others are numbered by
    ranges, and their segments built by different tasks."""
    hot, hot_path = write_table(
        rows.where(F.col(item).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > F.lit(width)).select(key), "hot-keys")
    some = hot.limit(1).count() > 0
    rest = rows.join(hot, key, "left_anti") if some else rows
    whole = rest.groupBy(key).agg(F.array_sort(F.collect_set(item)).alias(out)).select(
        key, F.lit(0).cast("long").alias("segment"), out)
    if not some:
        drop_table(rows.sparkSession, hot_path)
        return whole
    numbered = _numbered(rows.where(F.col(item).isNotNull()).join(hot, key, "left_semi").distinct(), key, item)
    return whole.unionByName(
        numbered.withColumn("segment", segment_of("number", width))
        .groupBy(key, "segment").agg(F.array_sort(F.collect_list(item)).alias(out)))
