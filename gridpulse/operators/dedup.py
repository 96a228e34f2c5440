"""One row per key. Both forms combine copies before the shuffle, so a key with many copies is cheap.

The ordered form compares structs, which Spark aggregates after sorting each task's rows: it spills, and
a key's rows needn't meet in one task before they are reduced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row ranked first by ``order_by`` (ascending, NULLs last) in every group.

    Ties are broken by the other columns, left to right. Same rows as ``row_number() = 1`` over a
    window, but as an aggregate: each task reduces its own rows of a group before any are moved.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [c for name in order_by if name not in keys for c in (F.isnull(name).alias(f"_null_{name}"), F.col(name))]
    tail = [F.col(c) for c in rest if c not in order_by]
    best = df.groupBy(*keys).agg(F.min(F.struct(*ranked, *tail)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in df.columns])


def dedup_batch(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """Keeps one row per key: any of them, or the first by ``order_by``. NULL keys equal each other."""
    if order_by:
        return first_per_group(df, keys, order_by)
    return df.dropDuplicates(list(keys))
