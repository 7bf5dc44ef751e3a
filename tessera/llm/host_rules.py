"""Quality rules with host-level verdicts.

Every document is measured (words, symbols, repeated lines, repeated word
windows). The *base* rules reject a document by itself. Documents that fail
the base rules or one of the softer ``RULES`` count as failures of their host
(``source``); a host's failure rate is shrunk towards the corpus by a beta
prior fitted to all hosts (method of moments), so a host of three pages is not
judged on its own rate. The verdict is joined back to the host's documents:

* ``blocked`` (rate >= ``BLOCK_RATE``): none of its documents is kept;
* ``strict`` (rate >= ``STRICT_RATE``): a document must pass every rule;
* ``open``: the base rules decide.

Defined results: a null or empty text has no words and fails the base; a null
source is a host of its own; repeated rows are judged alike; an empty table
gives an empty result; other columns are ignored (or, by
:func:`filter_documents`, returned as they came).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import append_columns, raw_texts
from tessera.session import drop_table, materialize, write_table

WINDOW = 5                # words of a window for the repetition measure
MIN_WORDS = 10
MAX_REPEAT_PCT = 20       # repeated words, % of the words
STRICT_RATE = 0.3
BLOCK_RATE = 0.8
MAX_CONCENTRATION = 1e4   # of the prior, for hosts that (almost) agree

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
_PREFIX = "__rule_"       # keeps the measures apart from columns of the input


def repeated_words(ids: np.ndarray, vocabulary: int) -> int:
    """Words lying in a ``WINDOW``-word window that occurs twice or more.

    ``ids`` numbers the words; windows are packed into exact integer codes,
    by steps (pairs, pairs of pairs, plus one word) when they do not fit."""
    n = len(ids)
    if n < WINDOW or vocabulary == n:
        return 0
    if vocabulary ** WINDOW < 2 ** 63:
        codes = ids[:n - WINDOW + 1].copy()
        for k in range(1, WINDOW):
            codes = codes * vocabulary + ids[k:n - WINDOW + 1 + k]
    else:
        pair = np.unique(ids[:-1] * vocabulary + ids[1:], return_inverse=True)[1]
        quad = np.unique(pair[:-2] * n + pair[2:], return_inverse=True)[1]
        codes = quad[:-1] * vocabulary + ids[WINDOW - 1:]
    _, place, times = np.unique(codes, return_inverse=True, return_counts=True)
    again = times[place] > 1
    covered = np.zeros(n, dtype=bool)
    for k in range(WINDOW):
        covered[k:n - WINDOW + 1 + k] |= again
    return int(covered.sum())


def measure(raw: bytes) -> tuple[int, int, int, int, int, int]:
    """The ``STATS`` of one text. ``bytes.split`` without argument splits at
    exactly the bytes 0x20 and 0x09-0x0D."""
    words = raw.split()
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words),
                      dtype=np.int64, count=len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), len(b"".join(words).decode("utf-8", "replace")),
            sum(raw.count(c) for c in (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")),
            len(lines) - len(set(lines)), repeated_words(ids, len(number)), len(lines))


def with_stats(docs: DataFrame) -> DataFrame:
    """``docs`` plus its measures, under prefixed names."""
    at = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = [measure(t) for t in raw_texts(batch.column(at))]
        return [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)]

    return append_columns(docs, run, [T.StructField(_PREFIX + s, T.LongType()) for s in STATS])


def _stat(name: str) -> Column:
    return F.col(_PREFIX + name)


def base_failed() -> Column:
    return ((_stat("n_words") < MIN_WORDS)
            | (_stat("n_repeat_words") * 100 > _stat("n_words") * MAX_REPEAT_PCT))


def rule_failed() -> Column:
    """Base failure, or: symbols over a fifth of the words, repeated lines
    over a third of the lines, words of 2 to 15 characters on average not met."""
    return (base_failed()
            | (_stat("n_symbols") * 5 > _stat("n_words"))
            | (_stat("n_dup_lines") * 3 > _stat("n_lines"))
            | (_stat("word_chars") < _stat("n_words") * 2)
            | (_stat("word_chars") > _stat("n_words") * 15))


def host_verdicts(measured: DataFrame) -> DataFrame:
    """``host, n_docs, n_failed, rate, verdict``: one row per source.

    Two small aggregates: failures per host (partial sums in the map tasks,
    so a hot host costs one row per task) and the prior over the hosts."""
    hosts = measured.groupBy(F.col("source").alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(rule_failed().cast("long")).alias("n_failed"))
    hosts = materialize(hosts, "hosts")
    n, f = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    m = hosts.select(F.sum(f) / F.sum(n)).scalar()
    spread = F.col("m") * (F.lit(1.0) - F.col("m"))
    k = F.when(F.col("v") * MAX_CONCENTRATION <= spread, F.lit(MAX_CONCENTRATION)).otherwise(
        F.greatest(F.lit(1.0), spread / F.col("v") - F.lit(1.0)))
    k = (hosts.select(m.alias("m"), n.alias("n"), (f / n - m).alias("d"))
         .agg(F.max("m").alias("m"), (F.sum(F.col("n") * F.col("d") * F.col("d")) / F.sum("n")).alias("v"))
         .select(k.alias("k")).scalar())
    rate = (f + m * k) / (n + k)
    verdict = (F.when(F.col("rate") >= BLOCK_RATE, "blocked")
               .when(F.col("rate") >= STRICT_RATE, "strict").otherwise("open"))
    return (hosts.withColumn("rate", rate)
            .select("host", "n_docs", "n_failed", "rate", verdict.alias("verdict")))


def _judged(measured: DataFrame, hosts: DataFrame) -> DataFrame:
    """``measured`` with its host's verdict and ``kept``. A plain join on the
    host: broadcast if the written host table is small, else a shuffle join
    whose hot hosts adaptive execution splits."""
    hosts = hosts.select(F.col("host").alias("__rule_host"), F.col("verdict").alias("__rule_verdict"),
                         F.col("rate").alias("__rule_rate"))
    kept = (~base_failed() & (F.col("__rule_verdict") != "blocked")
            & ~((F.col("__rule_verdict") == "strict") & rule_failed()))
    return (measured.join(hosts, F.col("source").eqNullSafe(F.col("__rule_host")), "left")
            .withColumn("__rule_kept", kept))


def apply_rules(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measures, ``base_failed``, ``host_rate``,
    ``host_verdict``, ``kept`` of every row. The texts are read once: the
    measures are written, then hosts are judged and joined from them."""
    measured = materialize(
        with_stats(docs.select("doc_id", "source", "text")).drop("text"), "measures")
    hosts = materialize(host_verdicts(measured), "verdicts")
    return _judged(measured, hosts).select(
        "doc_id", *(_stat(s).alias(s) for s in STATS), base_failed().alias("base_failed"),
        F.round("__rule_rate", 9).alias("host_rate"), F.col("__rule_verdict").alias("host_verdict"),
        F.col("__rule_kept").alias("kept"))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns. The texts
    are read twice (hosts, rows) and never shuffled."""
    slim, path = write_table(with_stats(docs.select("source", "text")).drop("text"), "measures")
    hosts = materialize(host_verdicts(slim), "verdicts")
    drop_table(docs.sparkSession, path)
    return _judged(with_stats(docs), hosts).where("__rule_kept").select(*docs.columns)
