"""A group's rows nested in time-ordered arrays of bounded length, whatever the group's size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.operators.groups import join_equal

# Rows one array may hold. A longer history goes on in further rows, numbered by ``history_part``.
HISTORY_LIMIT = 200_000


def histories(
    df: DataFrame,
    keys: Sequence[str],
    entry: Column,
    name: str,
    order: Sequence[str],
    cell: Sequence[Column],
    limit: int = HISTORY_LIMIT,
) -> DataFrame:
    """Rows (``keys``, history_part, ``name``): the group's ``entry`` values in ``order``, ``limit`` to a part.

    The part is floor(position / limit) for the exact position in the group, so it depends on the data alone. Rows are
    numbered inside a group's cells, and the cells' counts say where each starts. ``cell`` has to rise with ``order``
    and to be so fine that one cell's rows are few, and so coarse that one group's cells are: a hot group is spread
    over as many tasks as it has cells, and only its counts meet. Rows equal in ``order`` may swap places.
    """
    keys, cells = list(keys), [f"_c{i}" for i in range(len(cell))]
    rows = df.select(
        *keys,
        *[c.alias(n) for c, n in zip(cell, cells, strict=True)],
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
        entry.alias("_entry"),
    )
    place = [F.col(f"_o{i}").asc_nulls_first() for i in range(len(order))]
    earlier = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in cells])
    before = F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    starts = rows.groupBy(*keys, *cells).agg(F.count(F.lit(1)).alias("_n")).withColumn("_start", F.coalesce(before, F.lit(0)))
    inside = F.row_number().over(Window.partitionBy(*keys, *cells).orderBy(*place)) - 1
    placed = join_equal(rows.withColumn("_at", inside), starts.drop("_n"), [*keys, *cells])
    position = F.col("_start") + F.col("_at")
    parts = placed.select(
        *keys, F.floor(position / limit).cast("int").alias("history_part"), F.struct(position.alias("at"), F.col("_entry").alias("e")).alias("_e")
    )
    # A task holds all arrays of its groups: so many tasks, whatever adaptive execution takes for small.
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = parts.repartition(n, *keys, "history_part")
    arrays = parts.groupBy(*keys, "history_part").agg(F.array_sort(F.collect_list("_e")).alias("_all"))
    return arrays.select(*keys, "history_part", F.col("_all.e").alias(name))


def with_first_part(measures: DataFrame, parts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``measures`` (a row for each group, with ``history_parts``) and part 0 of its history, empty where it has none."""
    first = parts.where("history_part = 0").drop("history_part")
    joined = join_equal(measures, first, keys, "left")
    empty = F.array().cast(parts.schema[name].dataType)
    others = [c for c in measures.columns if c != "history_parts"]
    return joined.select(*others, F.coalesce(name, empty).alias(name), "history_parts")
