from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Milliseconds of the years 1 to 9999; a number outside is no event time (nanoseconds, say).
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999


def event_time(epoch_ms: Column | str, precision: str = "second") -> Column:
    """Epoch milliseconds as a timestamp; NULL for text that is no number and for numbers out of range.

    ``second`` cuts the milliseconds off, as the silver tables do; ``millis`` keeps them.
    """
    given = F.col(epoch_ms) if isinstance(epoch_ms, str) else epoch_ms
    ms = given.try_cast("bigint")
    ms = F.when(ms.between(FIRST_MS, LAST_MS), ms)
    if precision == "millis":
        return F.timestamp_millis(ms)
    if precision != "second":
        raise ValueError(f"precision must be 'second' or 'millis', not {precision!r}")
    return F.timestamp_seconds((ms / F.lit(1000)).cast("bigint"))


def with_audit(df: DataFrame, name: str) -> DataFrame:
    """Adds the processing time: one value per query or micro-batch."""
    return df.withColumn(name, F.current_timestamp())
