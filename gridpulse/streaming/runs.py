"""Incremental stream runs: take what has arrived, append it, report, stop."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gridpulse.operators.layout import stream_layout
from gridpulse.streaming.late import ROCKS, STORE

# For a session that names no state store: keys on disk and in so much memory an executor, not all of them on its heap.
STATE = {
    STORE: ROCKS,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
}


@dataclass(frozen=True)
class StreamRun:
    """What one run did: rows read, rows dropped as late, and the counts observed.

    A plan that branches reads its source once for each branch, and ``input_rows`` counts each reading.
    """

    batches: int
    input_rows: int
    late_rows: int
    observed: dict[str, dict[str, int]] = field(default_factory=dict)


def write_stream(
    df: DataFrame,
    path: str | None,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    name: str | None = None,
    poll_seconds: int = 5,
) -> StreamRun:
    """Appends everything available to the parquet folder ``path``, or to the table ``name``.

    The checkpoint folder remembers what was read: the next run goes on from there, also after a
    crash, and the file sink's log keeps a repeated batch from being written twice. Rows of a table with
    ``partition_by`` are gathered, or every task would write a file for each value.
    """
    writer = (
        (stream_layout(df, partition_by) if partition_by else df).writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _run(df.sparkSession, lambda: writer.toTable(name) if name else writer.start(path), poll_seconds)


def process_stream(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, poll_seconds: int = 5
) -> StreamRun:
    """Gives everything available to ``handle(rows, batch)``, micro-batch by micro-batch.

    After a crash the last batch comes again with its number, so ``handle`` has to replace what it wrote for it.
    """
    writer = df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return _run(df.sparkSession, writer.start, poll_seconds)


def _run(spark: SparkSession, start: Callable[[], StreamingQuery], poll_seconds: int) -> StreamRun:
    settings = {"spark.sql.streaming.numRecentProgressUpdates": "100000"}
    if spark.conf.get(STORE, None) is None:
        settings |= {k: v for k, v in STATE.items() if spark.conf.get(k, None) is None}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        query = start()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)

    seen: dict[int, object] = {}
    done = False
    while not done:
        # Only the latest reports are kept by Spark, so they are picked up while the run goes on.
        done = query.awaitTermination(poll_seconds)
        for progress in query.recentProgress:
            seen[progress.batchId] = progress

    # The counts below are totals: a report that Spark no longer holds must not go unnoticed.
    ids = sorted(seen)
    if ids and ids != list(range(ids[0], ids[-1] + 1)):
        raise RuntimeError(f"progress of {ids[-1] - ids[0] + 1 - len(ids)} micro-batches was lost")
    late = sum(op.numRowsDroppedByWatermark for p in seen.values() for op in p.stateOperators)
    observed: dict[str, Counter] = {}
    for progress in seen.values():
        for label, row in progress.observedMetrics.items():
            observed.setdefault(label, Counter()).update({k: v or 0 for k, v in row.asDict().items()})
    return StreamRun(
        batches=len(seen),
        input_rows=sum(p.numInputRows for p in seen.values()),
        late_rows=late,
        observed={label: dict(counts) for label, counts in observed.items()},
    )
