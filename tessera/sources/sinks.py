"""Text sinks in the reference's output shapes. All refuse an existing path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _write_text(df: DataFrame, line, path: str, order_by) -> None:
    """Write one text line per row; with ``order_by`` the files hold the rows
    in that order (a range-partitioned sort at the sink, nowhere earlier)."""
    if order_by:
        df = df.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    df.select(line.alias("value")).write.mode("errorifexists").text(path)


def write_kv(df: DataFrame, path: str, key: str, value: str | list[str],
             order_by: str | list[str] | None = None) -> None:
    """``key <TAB> value`` lines (the default key/value text output); several
    value columns give ``key <TAB> v1 <TAB> v2`` (e.g. node, distance, route)."""
    values = [value] if isinstance(value, str) else list(value)
    line = F.concat_ws("\t", F.col(key).cast("string"),
                       *[F.col(v).cast("string") for v in values])
    _write_text(df, line, path, order_by)


def write_tuples(df: DataFrame, path: str, word: str = "word", cnt: str = "cnt",
                 order_by: str | list[str] | None = None) -> None:
    """``(word,n)`` lines, the printed form of a (string, count) tuple."""
    _write_text(df, F.format_string("(%s,%d)", F.col(word), F.col(cnt)), path, order_by)


def write_pairs(df: DataFrame, path: str,
                order_by: str | list[str] | None = None) -> None:
    """``(rid_a,rid_b) <TAB> sim`` lines for a similarity-join result."""
    line = F.concat(F.format_string("(%d,%d)", F.col("rid_a"), F.col("rid_b")),
                    F.lit("\t"), F.col("sim").cast("string"))
    _write_text(df, line, path, order_by)
