"""Connected components of a large graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import merged_beyond, stored


def _summary(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (u, v: long, not NULL); root is its component's smallest node.

    Each round every node links its larger neighbours to its smallest one, then its smaller neighbours likewise. The
    edge count never grows, rounds rise with the logarithm of the size, and no neighbour list is held in one task:
    minima are aggregated before the shuffle and joined back. Each round is written to the shared folder.
    """
    edges = stored(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    before = _summary(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(merged_beyond(least, before[0]), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(merged_beyond(least, before[0]), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _summary(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
