"""The corpus pipeline: five stages from raw documents to a mixture.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as
the next stage's ``docs``. All but the last return the columns of ``docs``.

Null texts count as empty (and are rejected by the rules); an empty table
passes through all stages; repeated rows are one near-duplicate group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, host_rules, mixing, pii, simhash
from tessera.llm.common import table
from tessera.session import materialize, owned_tables


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and their host's verdict keep."""
    return host_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return pii.mask(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of each document that the mixture takes."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("mixture", mixture),
]

# Random rounding and disguised personal data are not SQL; tests/llm compares
# run() with a brute-force version.
ORACLE_SQL = None


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` of ``sf_dir`` after all stages but the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``. The stages' tables are
    deleted at the end; :func:`write_corpus` writes the texts."""
    with owned_tables(spark) as keep:
        return keep(STAGES[-1][1](spark, _cleaned(spark, sf_dir), sf_dir), "pipeline")


def write_corpus(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Write the corpus to the Parquet folder ``path``, which must not exist: the rows of
    ``documents`` that :func:`run` takes, their personal data masked, with ``copies``."""
    with owned_tables(spark):
        corpus = mixing.mixed_texts(_cleaned(spark, sf_dir))
        corpus.write.mode("errorifexists").parquet(path)
        return spark.read.schema(corpus.schema).parquet(path)
