"""Helpers the operators of this package share: reading, shared tables, ids and buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.session import new_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# The characters \x20 and \x09 to \x0D: what bytes.split() without argument splits at.
SPACES = " \t\n\x0b\x0c\r"
# Spark may choose a broadcast for joins of tables with so many counted rows; it sizes larger ones by their compressed files.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later jobs, and tasks run anew, don't repeat it."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merged_beyond(df: DataFrame, rows: int) -> DataFrame:
    """``df`` as a side of a join that is sorted and merged if the tables joined have more than ``BROADCAST_ROWS`` rows."""
    return df.hint("merge") if rows > BROADCAST_ROWS else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; pure ASCII strings take the faster built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def texts(docs: DataFrame, *others: str) -> DataFrame:
    """Columns ``d`` (doc_id as long), ``rid`` (fingerprint of the text), ``t`` (text, NULL as empty) and ``others``.

    Nothing else of ``docs`` is read, so its further columns can have any name. Rows with the same doc_id and text
    have the same ``d`` and ``rid`` and get the same result.
    """
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("d"), F.xxhash64(t).alias("rid"), t.alias("t"), *others)


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor
