"""Fact table: how far the nearest defender is from every receiver at every instant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.keys import surrogate_key
from gridpulse.operators.nearest import SMALL_GROUP, nearest_per_group

ALL_GAMES = "TODOS"  # fixed value: the filter setting that means no filter
GAME_SETTING = "gridpulse.filter.game_id"


def configured_game(spark: SparkSession) -> str:
    """The game that the session's settings name for this run, or all of them."""
    return spark.conf.get(GAME_SETTING, ALL_GAMES)


def separation_fact(
    silver: DataFrame,
    game_id: str | None = None,
    offense: str = "WR",
    defense: str = "CB",
    match_on: Sequence[str] = ("play_id", "timestamp"),
    small_group: int = SMALL_GROUP,
) -> DataFrame:
    """One row per game, play, instant and receiver, with the nearest defender's key.

    Players meet when they agree in ``match_on``. The default leaves the game out, so equal play ids
    of two games at the same second meet too; ``("game_id", "play_id", "timestamp")`` keeps games
    apart. With times cut to seconds the distance is the smallest over all samples of that second.
    """
    if game_id is not None and game_id != ALL_GAMES:
        silver = silver.where(F.col("game_id") == game_id)
    grain = ["game_id", "play_id", "timestamp"]
    closest = nearest_per_group(
        silver.where(F.col("position") == offense).withColumnRenamed("player_id", "_receiver"),
        silver.where(F.col("position") == defense),
        on=match_on,
        left_keys=[*grain, "_receiver"],
        right_id="player_id",
        right_name="_defender",
        distance_name="separation_yards",
        small_group=small_group,
    )
    return closest.select(
        *grain,
        "separation_yards",
        surrogate_key("game_id").alias("game_sk"),
        surrogate_key("game_id", "play_id").alias("play_sk"),
        surrogate_key("_receiver").alias("offensive_player_sk"),
        surrogate_key("_defender").alias("defensive_player_sk"),
    )
