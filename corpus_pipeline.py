"""Corpus pipeline: known language, repeated lines, near-duplicates, benchmark passages, packing.

Each stage reads what the stage before it wrote. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridpulse.llm.common import stored, table
from gridpulse.llm.decontaminate import without_leaks
from gridpulse.llm.language import with_known_language
from gridpulse.llm.line_dedup import without_repeated_lines
from gridpulse.llm.packing import pack
from gridpulse.llm.simhash import one_of_each_group


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; those that come out as ``und`` go."""
    return with_known_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each line kept by the first that holds it."""
    return without_repeated_lines(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each near-duplicate component."""
    return one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences of the remaining documents with their batches."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

# Language models, fingerprints and dynamic programming are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
