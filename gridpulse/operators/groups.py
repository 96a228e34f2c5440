"""Finding groups too large for one task, and cutting large groups into ordered blocks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.session import cut_lineage

# A table of group keys is broadcast up to this many rows (counted first), joined by shuffle beyond.
BROADCAST_ROWS = 200_000


def join_equal(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, where NULL equals NULL as it does in a grouping. Keys come from the left."""
    side = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(side, condition, how).drop(*[f"_right_{k}" for k in keys])


@dataclass(frozen=True)
class LargeGroups:
    """The keys of the groups above a size limit, written once and counted."""

    keys: tuple[str, ...]
    frame: DataFrame
    count: int

    @classmethod
    def find(cls, counts: DataFrame, keys: Sequence[str]) -> LargeGroups | None:
        """``counts`` holds one row per large group; None when it is empty, the usual case."""
        if counts.isEmpty():
            return None
        kept = cut_lineage(counts.select(*keys))
        return cls(tuple(keys), kept, kept.count())

    def _join(self, df: DataFrame, how: str) -> DataFrame:
        return join_equal(df, F.broadcast(self.frame) if self.count <= BROADCAST_ROWS else self.frame, self.keys, how)

    def within(self, df: DataFrame) -> DataFrame:
        return self._join(df, "left_semi")

    def outside(self, df: DataFrame) -> DataFrame:
        return self._join(df, "left_anti")


@dataclass(frozen=True)
class Blocks:
    """Rows in a total order, cut into runs of at most ``size`` rows numbered by ``_block``.

    Block numbers rise with the order and lie below ``span``; some numbers are unused.
    """

    frame: DataFrame
    span: int


def ordered_blocks(df: DataFrame, order: Sequence[str], size: int) -> Blocks:
    """Range-partitions by ``order``, so that a large group spreads over many tasks.

    Rows equal in ``order`` are told apart by the task that read them, so copies spread as well.
    The result is checkpointed: block numbers must not change when a lost task runs again.
    """
    sorted_rows = cut_lineage(
        df.withColumn("_reader", F.spark_partition_id())
        .repartitionByRange(*order, "_reader")
        .sortWithinPartitions(*order, "_reader")
        .withColumn("_at", F.monotonically_increasing_id())
        .drop("_reader")
    )
    # The identifier holds the partition number above bit 33 and the row number below it.
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    extent = sorted_rows.agg(F.max(part).alias("part"), F.max(row).alias("row")).first()
    if extent["row"] is None:
        return Blocks(sorted_rows.withColumn("_block", F.lit(0).cast("bigint")).drop("_at"), 1)
    per_part = extent["row"] // size + 1
    block = part * F.lit(per_part) + F.floor(row / F.lit(size))
    return Blocks(sorted_rows.withColumn("_block", block.cast("bigint")).drop("_at"), (extent["part"] + 1) * per_part)
