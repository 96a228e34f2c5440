"""Record layouts. Column names and types are fixed values: they are the input contract."""

from pyspark.sql.types import (
    BinaryType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, NUMBER, WHOLE = StringType(), DoubleType(), IntegerType()


def layout(*columns: tuple[str, DataType]) -> StructType:
    """Nullable columns in order."""
    return StructType([StructField(name, kind) for name, kind in columns])


# Telemetry events.
TELEMETRY = layout(
    ("game_id", TEXT),
    ("play_id", TEXT),
    ("play_status", TEXT),
    ("player_id", TEXT),
    ("player_name", TEXT),
    ("position", TEXT),
    ("team", TEXT),
    ("x_coord", NUMBER),
    ("y_coord", NUMBER),
    ("speed_mph", NUMBER),
    ("acceleration_m_s2", NUMBER),
    ("heart_rate_bpm", WHOLE),
    ("stamina_pct", NUMBER),
    ("timestamp", LongType()),
)

# Records as the Kafka source gives them.
KAFKA_RECORD = layout(
    ("key", BinaryType()),
    ("value", BinaryType()),
    ("topic", TEXT),
    ("partition", WHOLE),
    ("offset", LongType()),
    ("timestamp", TimestampType()),
)

# CSV columns are all text; the dimension plans give them types.
DIM_GAME_CSV = layout(
    ("game_id", TEXT),
    ("season", TEXT),
    ("week", TEXT),
    ("home_team", TEXT),
    ("away_team", TEXT),
    ("stadium", TEXT),
    ("turf_type", TEXT),
    ("weather_conditions", TEXT),
    ("temperature_f", TEXT),
)

DIM_PLAY_CSV = layout(
    ("play_id", TEXT),
    ("game_id", TEXT),
    ("quarter", TEXT),
    ("down", TEXT),
    ("distance_to_first", TEXT),
    ("expected_coverage", TEXT),
    ("play_result", TEXT),
)

DIM_PLAYER_CSV = layout(
    ("player_sk", TEXT),
    ("full_name", TEXT),
    ("team", TEXT),
    ("position", TEXT),
    ("height_in", TEXT),
    ("weight_lbs", TEXT),
    ("college", TEXT),
    ("draft_year", TEXT),
)
