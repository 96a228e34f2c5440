from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

SPREAD = 32


def dedup_stream(
    df: DataFrame,
    keys: Sequence[str],
    event_time: str = "timestamp",
    delay: str = "1 minute",
    spread_by: str | None = None,
    spread: int = SPREAD,
) -> DataFrame:
    """First row per key over all micro-batches; rows more than ``delay`` late are dropped.

    ``event_time`` must be one of ``keys``: then a key's state ends when the watermark passes it. Rows
    without event time never would, so they take a way of their own past the state: all of them stay,
    copies included. The stream's report counts either way, as ``timed`` and ``untimed`` rows that came in.

    A streaming dedup sends all copies of a key to one task. So copies are first reduced in ``spread``
    places, told apart by ``spread_by`` (a record's offset, say), by column ``offset`` where there is
    one, or else by a hash of the row, which still spreads copies that differ anywhere. ``spread=1``
    leaves this step out.
    """
    if event_time not in keys:
        raise ValueError("event_time must be one of the keys, or state would never end")
    untimed = df.where(F.col(event_time).isNull())
    timed = df.where(F.col(event_time).isNotNull())
    if df.isStreaming:
        arrived = F.count(F.lit(1)).alias("rows")
        timed, untimed = timed.observe("timed", arrived), untimed.observe("untimed", arrived)
    marked = timed.withWatermark(event_time, delay)
    if spread > 1:
        place = F.pmod(F.xxhash64(*_told_apart(df, spread_by)), F.lit(spread))
        marked = marked.withColumn("_place", place).dropDuplicates([*keys, "_place"]).drop("_place")
    return marked.dropDuplicates(list(keys)).unionByName(untimed)


def _told_apart(df: DataFrame, spread_by: str | None) -> list[str]:
    if spread_by or "offset" in df.columns:
        return [spread_by or "offset"]
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (ArrayType, MapType, StructType))]
