"""Game, play and player dimensions: CSV text to typed, keyed, checked tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from gridpulse import schemas
from gridpulse.functions.keys import surrogate_key
from gridpulse.functions.numbers import to_number
from gridpulse.functions.times import with_audit
from gridpulse.operators.quality import Expectations
from gridpulse.plans import rules
from gridpulse.sources.files import read_dimension_csv


@dataclass(frozen=True)
class DimensionPlan:
    """How one dimension is read, typed, keyed, checked and published."""

    file: str
    csv_schema: StructType
    key: str
    key_parts: tuple[str, ...]
    integers: tuple[str, ...]
    expectations: Expectations
    published: tuple[str, ...]

    def bronze(self, spark: SparkSession, folder: str) -> DataFrame:
        return read_dimension_csv(spark, f"{folder.rstrip('/')}/{self.file}", self.csv_schema)

    def unchecked(self, bronze: DataFrame) -> DataFrame:
        """Silver before its rules. The key may replace its own source column."""
        keyed = bronze.withColumn(self.key, surrogate_key(*self.key_parts))
        typed = keyed.withColumns({c: to_number(c, "int") for c in self.integers})
        return with_audit(typed, "ingestion_timestamp")

    def silver(self, bronze: DataFrame) -> DataFrame:
        return self.expectations.keep(self.unchecked(bronze))

    def gold(self, silver: DataFrame) -> DataFrame:
        return silver.select(*self.published)


GAME = DimensionPlan(
    file="dim_game.csv",
    csv_schema=schemas.DIM_GAME_CSV,
    key="game_sk",
    key_parts=("game_id",),
    integers=("season", "week", "temperature_f"),
    expectations=rules.GAME_RULES,
    published=(
        "game_sk", "game_id", "season", "week", "home_team", "away_team",
        "stadium", "turf_type", "weather_conditions", "temperature_f",
    ),
)

PLAY = DimensionPlan(
    file="dim_play.csv",
    csv_schema=schemas.DIM_PLAY_CSV,
    key="play_sk",
    key_parts=("game_id", "play_id"),
    integers=("down", "distance_to_first"),
    expectations=rules.PLAY_RULES,
    published=(
        "play_sk", "play_id", "game_id", "quarter", "down",
        "distance_to_first", "expected_coverage", "play_result",
    ),
)

# player_sk holds the raw player id in the CSV and its hash from silver on. The rule on the empty id
# sees the hash, so an empty id passes; give ``silver`` rows without them where that matters.
PLAYER = DimensionPlan(
    file="dim_player.csv",
    csv_schema=schemas.DIM_PLAYER_CSV,
    key="player_sk",
    key_parts=("player_sk",),
    integers=("height_in", "weight_lbs"),
    expectations=rules.PLAYER_RULES,
    published=(
        "player_sk", "full_name", "team", "position",
        "height_in", "weight_lbs", "college", "draft_year",
    ),
)

DIMENSIONS = {"game": GAME, "play": PLAY, "player": PLAYER}
