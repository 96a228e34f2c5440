"""Ranked matchups of receivers and defenders under pressure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.operators.star import Dimension, star_join


def matchup_report(
    fact: DataFrame, players: DataFrame, plays: DataFrame, down: int = 3, min_plays: int = 3, top_n: int = 10
) -> DataFrame:
    """The ``top_n`` pairs by mean separation, over plays on ``down``, that met in ``min_plays`` plays.

    The instants of a play are combined per pair before the player names are joined, so the joins and
    the distinct count see one row per pair and play. They are spread by pair and play before that: groups
    combined where they were read would be as many in one task as its file has. Equal means are ranked by name.
    """
    chosen = plays.where(F.col("down") == down)
    one = ["offensive_player_sk", "defensive_player_sk", "play_sk"]
    instants = star_join(fact, [Dimension(chosen, "play_sk", "play_sk", {})]).select(*one, "separation_yards")
    per_play = instants.repartition(*one).groupBy(*one).agg(
        F.sum("separation_yards").alias("_sum"),
        F.count("separation_yards").alias("_count"),
        F.max("separation_yards").alias("_max"),
    )
    named = star_join(
        per_play,
        [
            Dimension(
                players, "player_sk", "offensive_player_sk", {"receptor_ofensivo": "full_name", "equipo": "team"}
            ),
            Dimension(players, "player_sk", "defensive_player_sk", {"esquinero_defensor": "full_name"}),
        ],
    )
    pair = ["receptor_ofensivo", "equipo", "esquinero_defensor"]
    return (
        named.groupBy(*pair)
        .agg(
            F.round(F.try_divide(F.sum("_sum"), F.sum("_count")), 2).alias("promedio_separacion_yardas"),
            F.round(F.max("_max"), 2).alias("maxima_separacion_yardas"),
            F.count_distinct("play_sk").alias("total_jugadas_analizadas"),
        )
        .where(F.col("total_jugadas_analizadas") >= min_plays)
        .orderBy(F.col("promedio_separacion_yardas").desc(), *pair)
        .limit(top_n)
    )
