"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch],
                schema: T.StructType) -> DataFrame:
    """``mapInArrow`` with one output batch per input batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
    return df.mapInArrow(run, schema)


def append_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], list[pa.Array]],
                   added: list[T.StructField]) -> DataFrame:
    """``df`` plus the columns that ``fn`` computes for each batch."""
    names = [*df.columns, *(f.name for f in added)]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, *fn(batch)], names=names)

    return map_batches(df, run, T.StructType([*df.schema.fields, *added]))


def id_remainder(doc_id: Column, m: int) -> Column:
    """crc32(doc_id as text) mod m; a null id counts as the empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(m)


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a text, null as empty."""
    blank = " \t\n\x0b\f\r"
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "),
                  F.lit(blank))
    spaces = F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit("")))
    return F.when(flat == F.lit(""), F.lit(0)).otherwise(spaces + F.lit(1)).cast("long")
