"""Typed, deduplicated, checked events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.numbers import to_number
from gridpulse.functions.times import event_time, with_audit
from gridpulse.operators.dedup import dedup_batch
from gridpulse.plans.rules import TELEMETRY_RULES
from gridpulse.streaming.dedup import dedup_stream
from gridpulse.streaming.late import mark_late

EVENT_KEYS = ("game_id", "play_id", "player_id", "timestamp")

# Columns of the arrival route that silver leaves behind; absent ones are ignored.
KAFKA_COLUMNS = ("topic", "partition", "offset", "kafka_timestamp")
FILE_COLUMNS = ("status", "test", "_rescued_data")


def clean_metrics(df: DataFrame, precision: str = "second") -> DataFrame:
    """Event time and numeric types; acceleration rounded to two places."""
    return df.withColumns(
        {
            "timestamp": event_time("timestamp", precision),
            "speed_mph": to_number("speed_mph", "double"),
            "heart_rate_bpm": to_number("heart_rate_bpm", "int"),
            "acceleration_m_s2": F.round(to_number("acceleration_m_s2", "double"), 2),
        }
    )


def silver_batch(
    bronze: DataFrame,
    drop: Sequence[str] = KAFKA_COLUMNS,
    precision: str = "second",
    keys: Sequence[str] = EVENT_KEYS,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Whole-table silver: copies are told by the millisecond time, before it is cut to seconds.

    So a player keeps every sample of a second, all with the same ``timestamp``. ``order_by`` says
    which copy stays (say ``("kafka_timestamp", "partition", "offset")`` for the first to arrive);
    without it any may. The rules come last: a copy that breaks them can have displaced a good one.
    """
    return TELEMETRY_RULES.keep(unchecked_silver_batch(bronze, drop, precision, keys, order_by))


def unchecked_silver_batch(
    bronze: DataFrame,
    drop: Sequence[str] = KAFKA_COLUMNS,
    precision: str = "second",
    keys: Sequence[str] = EVENT_KEYS,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """``silver_batch`` before its rules, for their metrics."""
    single = dedup_batch(bronze, keys, order_by)
    return with_audit(clean_metrics(single, precision).drop(*drop), "silver_processed_at")


def silver_stream(
    bronze: DataFrame,
    drop: Sequence[str] = KAFKA_COLUMNS,
    precision: str = "second",
    keys: Sequence[str] = EVENT_KEYS,
    delay: str = "1 minute",
    spread_by: str | None = None,
) -> DataFrame:
    """Incremental silver: the time is cut to seconds first, so one sample per player and second stays."""
    return _checked(dedup_stream(clean_metrics(bronze, precision), keys, "timestamp", delay, spread_by).drop(*drop))


def marked_stream(
    bronze: DataFrame, precision: str = "second", keys: Sequence[str] = EVENT_KEYS, delay: str = "1 minute"
) -> DataFrame:
    """Typed, single events and all late ones, told apart by ``late``: what ``silver_of_marked`` and ``late_of_marked`` read."""
    return mark_late(clean_metrics(bronze, precision), keys, "timestamp", delay)


def silver_of_marked(marked: DataFrame, drop: Sequence[str] = KAFKA_COLUMNS) -> DataFrame:
    """The silver of a marked stream, the same as ``silver_stream`` gives."""
    return _checked(marked.where("NOT late").drop("late", *drop))


def late_of_marked(marked: DataFrame) -> DataFrame:
    """Late rows with all their columns, unchecked, so that they can be looked into or fed in again."""
    return with_audit(marked.where("late").drop("late"), "set_aside_at")


def _checked(single: DataFrame) -> DataFrame:
    typed = with_audit(single, "silver_processed_at")
    return TELEMETRY_RULES.keep(TELEMETRY_RULES.observe(typed, "silver_rules"))
