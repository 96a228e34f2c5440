"""Gold kept up to date by what is new: each arrival's partial results are stored, and merged for the games it touches.

An arrival adds, for every group it has rows of, sums, counts and maxima, its entries in order, and the keys it has seen.
These partials are written once, partitioned by game and arrival, and never change. The gold rows of a game are
what its partials give together, so an arrival rewrites the partitions of its own games and reads nothing of the others.
Everything written for an arrival replaces what an earlier attempt at it wrote, so a repeated arrival changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridpulse.functions.times import with_audit
from gridpulse.operators.groups import LargeGroups, join_equal
from gridpulse.operators.histories import HISTORY_LIMIT, with_first_part
from gridpulse.operators.layout import partition_layout
from gridpulse.plans.gold import ACCELERATIONS, PLAY_KEYS, PLAYER_KEYS, SAMPLES, History, history_parts
from gridpulse.sources.tables import Layer

# So many touched games are named in the filter of a read; more are joined.
NAMED_GAMES = 10_000


@dataclass(frozen=True)
class Rollup:
    """A gold table whose rows merge.

    ``partial`` aggregates new rows, ``merged`` aggregates partials to the same columns, ``result`` makes the measures
    of them. ``distinct`` counts a column's different values: (column, name of the count).
    """

    name: str
    history_table: str
    keys: tuple[str, ...]
    history: History
    partial: Callable[[], dict[str, Column]]
    merged: Callable[[], dict[str, Column]]
    result: Callable[[], dict[str, Column]]
    distinct: tuple[str, str] | None = None


def _mean(name: str) -> Column:
    return F.try_divide(F.col(f"{name}_sum"), F.col(f"{name}_n"))


PLAYERS = Rollup(
    "player_features",
    "player_histories",
    PLAYER_KEYS,
    ACCELERATIONS,
    lambda: {
        "speed_sum": F.sum("speed_mph"),
        "speed_n": F.count("speed_mph"),
        "speed_max": F.max("speed_mph"),
        "heart_sum": F.sum(F.col("heart_rate_bpm").cast("double")),
        "heart_n": F.count("heart_rate_bpm"),
        "heart_max": F.max("heart_rate_bpm"),
    },
    lambda: {c: (F.max if c.endswith("max") else F.sum)(c) for c in ("speed_sum", "speed_n", "speed_max", "heart_sum", "heart_n", "heart_max")},
    lambda: {
        "avg_speed_mph": F.round(_mean("speed"), 2),
        "max_speed_today": F.col("speed_max"),
        "avg_heart_rate": F.round(_mean("heart"), 0),
        "peak_heart_rate": F.col("heart_max"),
    },
)
PLAYS = Rollup(
    "play_trajectory",
    "play_histories",
    PLAY_KEYS,
    SAMPLES,
    lambda: {"speed_max": F.max("speed_mph")},
    lambda: {"speed_max": F.max("speed_max")},
    lambda: {"max_speed_in_play": F.round("speed_max", 2)},
    ("player_id", "players_tracked"),
)


class Games:
    """The games an arrival has rows of, and the choice of their partitions."""

    def __init__(self, new: DataFrame, by: str):
        self.by, self.frame = by, new.select(by).distinct()
        named = self.frame.limit(NAMED_GAMES + 1).collect()
        self.names = [r[0] for r in named] if len(named) <= NAMED_GAMES else None

    def within(self, rows: DataFrame) -> DataFrame:
        """The rows of these games. While they can be named, nothing else is read."""
        if self.names is None:
            return join_equal(rows, self.frame, [self.by], "left_semi")
        chosen = F.col(self.by).isin([v for v in self.names if v is not None])
        return rows.where(chosen | F.col(self.by).isNull() if None in self.names else chosen)


def replace_partitions(rows: DataFrame, path: str, by: list[str]) -> None:
    """Writes ``rows`` to a folder partitioned by ``by``; partitions without rows stay as they are."""
    laid = partition_layout(rows, by)
    laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def history_entries(rows: DataFrame, rollup: Rollup, limit: int) -> DataFrame:
    """New rows as (keys, entries): their order columns as structs, at most ``limit`` in an array."""
    whole = replace(rollup.history, name="entries", entry=lambda e: e)
    return whole.build(rows, rollup.keys, limit).drop("history_part")


def merged_histories(entries: DataFrame, sizes: DataFrame, rollup: Rollup, limit: int) -> DataFrame:
    """All arrivals' ``entries`` of a group in order, ``limit`` to a part. ``sizes`` has their number (``entries_n``).

    Arrays that fit in one part are joined and sorted; a longer group's entries are numbered anew, in its cells.
    """
    h, keys = rollup.history, list(rollup.keys)
    large = LargeGroups.find(sizes.where(F.col("entries_n") > limit), keys)
    short = entries if large is None else large.outside(entries)
    joined = F.array_sort(F.flatten(F.collect_list("entries")))
    whole = short.groupBy(*keys).agg(joined.alias("_all"))
    out = whole.select(*keys, F.lit(0).alias("history_part"), F.transform("_all", h.entry).alias(h.name))
    if large is None:
        return out
    return out.unionByName(h.build(large.within(entries).select(*keys, F.inline("entries")), keys, limit))


class IncrementalGold:
    """The gold tables in folder ``base``, kept by ``update`` from new silver rows."""

    def __init__(self, spark: SparkSession, base: str, by: str = "game_id", limit: int = HISTORY_LIMIT, stamp: bool = True):
        self.spark, self.base, self.by, self.limit, self.stamp = spark, base, by, limit, stamp
        self.rollups = (PLAYERS, PLAYS)

    def tables(self, silver: StructType) -> dict[str, Layer]:
        """The tables by name; those that do not exist yet are created, empty."""
        nothing, out = self.spark.createDataFrame([], silver), {}
        for rollup in self.rollups:
            partials = self._partials(rollup, nothing)
            merged = self._merged(rollup, partials["measures"])
            parts = merged_histories(partials["entries"], merged, rollup, self.limit)
            for name, rows in ((rollup.history_table, parts), (rollup.name, self._table(rollup, merged, partials, parts))):
                path = f"{self.base}/{name}"
                self.spark.createDataFrame([], rows.schema).write.mode("append").partitionBy(self.by).parquet(path)
                out[name] = Layer(self.spark, path=path, schema=rows.schema)
        return out

    def update(self, new: DataFrame, arrival: int) -> None:
        """Takes in the silver rows ``new``, all of those that came with ``arrival``."""
        games = Games(new, self.by)
        if games.names == []:
            return
        for rollup in self.rollups:
            partials = {}
            for kind, rows in self._partials(rollup, new).items():
                folder = f"{self.base}/partials/{rollup.name}/{kind}"
                dated = rows.withColumn("arrival", F.lit(arrival))
                replace_partitions(dated, folder, [self.by, "arrival"])
                partials[kind] = games.within(self.spark.read.schema(dated.schema).parquet(folder)).drop("arrival")
            merged = self._merged(rollup, partials["measures"])
            parts = merged_histories(partials["entries"], merged, rollup, self.limit)
            folder = f"{self.base}/{rollup.history_table}"
            replace_partitions(parts, folder, [self.by])
            written = games.within(self.spark.read.schema(parts.schema).parquet(folder))
            replace_partitions(self._table(rollup, merged, partials, written), f"{self.base}/{rollup.name}", [self.by])

    def _partials(self, rollup: Rollup, new: DataFrame) -> dict[str, DataFrame]:
        measures = new.groupBy(*rollup.keys).agg(
            *[c.alias(n) for n, c in rollup.partial().items()], F.count_if(F.expr(rollup.history.known)).alias("entries_n")
        )
        out = {"measures": measures, "entries": history_entries(new, rollup, self.limit)}
        if rollup.distinct:
            out["seen"] = new.select(*rollup.keys, rollup.distinct[0]).distinct()
        return out

    def _merged(self, rollup: Rollup, measures: DataFrame) -> DataFrame:
        merged = [c.alias(n) for n, c in rollup.merged().items()]
        return measures.groupBy(*rollup.keys).agg(*merged, F.sum("entries_n").alias("entries_n"))

    def _table(self, rollup: Rollup, merged: DataFrame, partials: dict[str, DataFrame], parts: DataFrame) -> DataFrame:
        keys = rollup.keys
        finished = [c.alias(n) for n, c in rollup.result().items()]
        measures = merged.select(*keys, *finished, history_parts(F.col("entries_n"), self.limit))
        if rollup.distinct:
            column, name = rollup.distinct
            measures = join_equal(measures, partials["seen"].groupBy(*keys).agg(F.count_distinct(column).alias(name)), keys)
        table = with_first_part(measures, parts, keys, rollup.history.name)
        return with_audit(table, "feature_timestamp") if self.stamp else table
