"""Builds the star schema: three dimensions from CSV, the separation fact, and the report on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gridpulse.plans.dimensions import DIMENSIONS
from gridpulse.plans.reports import matchup_report
from gridpulse.plans.separation import configured_game, separation_fact
from gridpulse.sources.tables import Layer, register_table, write_table


def build_dimensions(
    spark: SparkSession, csv_folder: str, out_dir: str, database: str | None = None
) -> dict[str, Layer]:
    """Writes bronze, silver and gold of every dimension below ``out_dir``; returns the gold tables.

    Next to them lies ``rules_dim_<name>``, how many rows each rule passed and failed. With ``database``
    the tables also get names there, comments and their ``quality``.
    """
    gold = {}
    for name, plan in DIMENSIONS.items():
        layers = {}

        def stored(level: str, df: DataFrame) -> DataFrame:
            path = f"{out_dir.rstrip('/')}/{level}_dim_{name}"
            write_table(df, path=path)
            layers[level] = Layer(spark, path=path, schema=df.schema)
            if database:
                table = f"{database}.{level}_dim_{name}"
                register_table(spark, table, path, f"Dimension {name}, {level}", {"quality": level})
            return layers[level].read()

        bronze = stored("bronze", plan.bronze(spark, csv_folder))
        silver = stored("silver", plan.silver(bronze))
        stored("rules", plan.expectations.metrics(plan.unchecked(bronze)))
        stored("gold", plan.gold(silver))
        gold[name] = layers["gold"]
    return gold


def build_fact(
    spark: SparkSession,
    silver: Layer,
    path: str,
    match_on: Sequence[str] = ("play_id", "timestamp"),
    cluster_by: Sequence[str] = (),
) -> Layer:
    """Writes the separation fact of the configured game, or of all games."""
    fact = separation_fact(silver.read(), game_id=configured_game(spark), match_on=match_on)
    write_table(fact, path=path, cluster_by=cluster_by)
    return Layer(spark, path=path, schema=fact.schema)


def report(fact: Layer, dimensions: dict[str, Layer]) -> DataFrame:
    return matchup_report(fact.read(), dimensions["player"].read(), dimensions["play"].read())
