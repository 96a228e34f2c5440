"""Streaming dedup that keeps late rows apart instead of dropping them."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import BooleanType, DoubleType, FloatType, StructField, StructType

# The processor travels with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# One piece of state holds the keys of one place and one such span of event time; keys are spread evenly over the places.
# A call into the state costs far more than a row, so pieces are few: their number grows with the time covered, not the rows.
SPAN = "1 day"
PLACES = 32
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstOrLate(StatefulProcessor):
    """Passes the first row of each key, rows behind the watermark as late, and no copies of what was passed.

    State is the keys seen, by instant, that the watermark has not reached; a timer at the last instant ends it.
    """

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)
        self.passed = Row(*self.columns, "late")

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "instants array<bigint>, others array<string>")

    def _seen(self) -> set[tuple[int, str]]:
        return set(zip(*self.seen.get(), strict=True)) if self.seen.exists() else set()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802
        watermark = timerValues.getCurrentWatermarkInMs()
        seen = self._seen()
        before = len(seen)
        for row in rows:
            own = (row["_at"], row["_others"])
            late = own[0] <= watermark
            if not late and own in seen:
                continue
            if not late:
                seen.add(own)
            yield self.passed(*[row[c] for c in self.columns], late)
        if len(seen) > before:
            self._keep(seen, watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        if self.seen.exists():
            self._keep(self._seen(), timerValues.getCurrentWatermarkInMs())
        return iter(())

    def _keep(self, seen: set[tuple[int, str]], watermark: int) -> None:
        still = sorted(k for k in seen if k[0] > watermark)
        if still:
            instants, others = zip(*still, strict=True)
            self.seen.update((list(instants), list(others)))
            self.handle.registerTimer(instants[-1])
        else:
            self.seen.clear()

    def close(self) -> None:
        pass


def mark_late(
    df: DataFrame, keys: Sequence[str], event_time: str = "timestamp", delay: str = "1 minute", span: str = SPAN
) -> DataFrame:
    """First row per key over all micro-batches, and every late row, with a column ``late`` that tells them apart.

    A row is late whose time the watermark (the latest time of the batches before, less ``delay``) has reached; copies
    of late rows are all passed on, as nothing remembers them. Rows without event time are never late and all stay.
    ``event_time`` must be one of ``keys``. The session's state store has to be RocksDB (``STORE`` = ``ROCKS``).
    """
    if event_time not in keys:
        raise ValueError("event_time must be one of the keys, or state would never end")
    # Spark drops late rows before a processor sees them if it finds the watermark's column among theirs, so the
    # processor gets a copy of that column, which is no longer marked; the watermark itself goes on.
    same_time = F.timestamp_micros(F.unix_micros(event_time))
    timed = df.where(F.col(event_time).isNotNull()).withWatermark(event_time, delay).withColumn(event_time, same_time)
    part = F.floor(F.unix_millis(event_time) / F.expr(f"unix_millis(timestamp_seconds(0) + interval {span})"))
    grouped = timed.withColumns({"_at": F.unix_millis(event_time), "_part": part})
    schema = StructType([*[StructField(f.name, f.dataType) for f in df.schema.fields], StructField("late", BooleanType())])
    others = _as_text(df, [k for k in keys if k != event_time])
    placed = grouped.withColumn("_others", others).withColumn("_place", F.pmod(F.xxhash64("_others", "_at"), F.lit(PLACES)))
    marked = placed.groupBy("_place", "_part").transformWithState(FirstOrLate(df.columns), schema, "Append", "EventTime")
    untimed = df.where(F.col(event_time).isNull()).withColumn("late", F.lit(False))
    return marked.unionByName(untimed)


def _as_text(df: DataFrame, keys: Sequence[str]) -> Column:
    """The values of ``keys``, NULLs included, as one text that is the same just where all of them are."""

    def plain(name: str) -> Column:
        kind = df.schema[name].dataType
        value = F.col(name) + F.lit(0.0).cast(kind) if isinstance(kind, (FloatType, DoubleType)) else F.col(name)  # -0.0 is 0.0
        return value.alias(name)

    # With the offset, so that an hour that clocks repeat is told apart.
    written = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    return F.to_json(F.struct(F.lit("").alias("_"), *map(plain, keys)), written)
