"""Row placement before a write, so that later scans skip files and row groups."""

from __future__ import annotations

from collections.abc import Sequence
from math import isfinite

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    MapType,
    NumericType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from gridpulse.functions.bits import spread_bits

# Rows whose values give the bucket bounds of a Z-order.
SAMPLE = 10_000
# Tasks, at least, that write the rows of one value of a stream's partition columns.
PLACES = 8
# Kinds that become a number, for which there is a faster search.
MEASURED = (NumericType, DateType, TimestampType, TimestampNTZType)


def partition_layout(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Gathers rows for a write partitioned by ``cols``: few files for small values, and several
    tasks for a large one (adaptive execution splits and merges the rebalanced partitions)."""
    return df.hint("rebalance", *cols)


def stream_layout(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Gathers a stream's rows for a write partitioned by ``cols``, where adaptive execution may not reach.

    The rows of a value go to a sixteenth of the shuffle's tasks, 8 at least, instead of all: that many files for
    each value and micro-batch, and that many tasks for a value that most rows have.
    """
    places = max(PLACES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16)
    place = F.pmod(F.xxhash64(*[f.name for f in df.schema.fields if not _holds_map(f.dataType)]), F.lit(places))
    return df.repartition(*cols, place)


def _holds_map(kind: DataType) -> bool:
    """Maps have no hash."""
    if isinstance(kind, StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, MapType) or isinstance(kind, ArrayType) and _holds_map(kind.elementType)


def cluster_layout(df: DataFrame, cols: Sequence[str], n: int | None = None) -> DataFrame:
    """Range-partitions and sorts by ``cols``; ``n`` files, or as many as shuffle partitions.

    Rows with arrays are gathered by ``cols`` instead and sorted in place: the bounds of ranges would
    be sampled from the finished rows, which builds every array twice.
    """
    if not n and any(isinstance(f.dataType, (ArrayType, MapType)) for f in df.schema.fields):
        return partition_layout(df, cols).sortWithinPartitions(*cols)
    return _by_range(df, list(cols), n)


def zorder_layout(df: DataFrame, cols: Sequence[str], n: int | None = None, bits: int = 8) -> DataFrame:
    """Range-partitions and sorts along the Z-order curve of ``cols``.

    Every column is replaced by the number of its quantile bucket (2^bits of them at most), and the bits
    of the bucket numbers are interleaved. Bounds are whole values, texts included, of about ``SAMPLE``
    random rows, thinned where they lie; they only place rows, so that another sample gives the same table.
    """
    if len(cols) == 1:
        return cluster_layout(df, cols, n)
    if len(cols) * bits > 63:
        raise ValueError("codes do not fit in 63 bits")
    rows = df.count()
    measures = [_measure(name, df.schema[name].dataType).alias(f"_m{i}") for i, name in enumerate(cols)]
    sample = df.select(*measures).sample(min(1.0, SAMPLE / rows), seed=1).collect() if rows else []
    measured, codes = df, []
    for i, name in enumerate(cols):
        values = sorted(r[i] for r in sample if r[i] is not None and r[i] == r[i])
        steps = 1 << bits
        bounds = sorted({values[k * len(values) // steps] for k in range(1, steps)} - {values[0]}) if values else []
        if bounds:
            measured, code = _bucket(measured, name, bounds, f"_code{i}")
            codes.append(code)
    if not codes:
        return cluster_layout(df, cols, n)
    z = spread_bits(codes, bits)
    placed = measured.select(*df.columns, z.alias("_z"))
    return _by_range(placed, ["_z"], n).drop("_z")


def _bucket(df: DataFrame, name: str, bounds: Sequence[object], code: str) -> tuple[DataFrame, Column]:
    """How many of the ascending ``bounds`` are at most the value of ``name``; 0 for NULL and NaN."""
    kind = df.schema[name].dataType
    if not isinstance(kind, MEASURED):
        # Bounds in one array, searched by halves: a position is compared once for each bit.
        ranked, place = F.array(*map(F.lit, bounds)), F.lit(0)
        step = 1 << (len(bounds).bit_length() - 1)
        while step:
            further = (place + step <= len(bounds)) & (F.get(ranked, place + (step - 1)) <= F.col(name))
            df = df.withColumn(f"{code}_{step}", place + F.when(further, F.lit(step)).otherwise(F.lit(0)))
            place, step = F.col(f"{code}_{step}"), step >> 1
        return df, F.coalesce(place, F.lit(0))
    inner = [b for b in bounds if isfinite(b)]
    if not inner:
        return df, F.lit(0)
    splits = [float("-inf"), *inner, float("inf")]
    found = Bucketizer(splits=splits, inputCol=f"{code}_m", outputCol=code, handleInvalid="keep")
    measured = df.withColumn(f"{code}_m", F.coalesce(F.nanvl(_measure(name, kind), F.lit(float("-inf"))), F.lit(float("-inf"))))
    return found.transform(measured), F.col(code).cast("int")


def _measure(name: str, kind: DataType) -> Column:
    """A double in the order of the values; texts and other kinds stay as they are."""
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(name).cast("double")
    return F.col(name).cast("double") if isinstance(kind, NumericType) else F.col(name)


def _by_range(df: DataFrame, order: list[str], n: int | None) -> DataFrame:
    # A value too frequent for one file is split further by a row hash (nested columns left out), and
    # copies of one row by the task that read them.
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (ArrayType, MapType, StructType))]
    spread = df.withColumn("_row", F.xxhash64(*plain)).withColumn("_reader", F.spark_partition_id())
    keys = [*order, "_row", "_reader"]
    ranged = spread.repartitionByRange(n, *keys) if n else spread.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys).drop("_row", "_reader")
