"""Word counts over lines of text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import delimited_pieces, split_on_space


def _count_words(words: DataFrame) -> DataFrame:
    # Map-side partial count; a hot word costs one partial row per task.
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def word_count_raw(lines: DataFrame, column: str = "value") -> DataFrame:
    """Case-sensitive counts of the words of each line split on one space
    (Java split rule: empty words between/leading spaces count, trailing ones
    do not; an empty line is one empty word). ``word, cnt``."""
    return _count_words(lines.select(F.explode(split_on_space(F.col(column))).alias("word")))


def word_count_normalized(lines: DataFrame, column: str = "value") -> DataFrame:
    """Counts of lower-cased words split on the fixed punctuation/space set,
    empty pieces dropped. ``word, cnt``."""
    pieces = lines.select(F.explode(delimited_pieces(F.col(column))).alias("piece"))
    words = pieces.where(F.col("piece") != F.lit("")).select(F.lower("piece").alias("word"))
    return _count_words(words)
