"""Small hand-made inputs shared by the tests."""

from pyspark.sql import functions as F

from gridpulse.schemas import TELEMETRY

BASE_MS = 1_700_000_000_000


def event(player, position, ms=0, x=0.0, y=0.0, **changes):
    """One telemetry row; ``ms`` counts from a fixed whole second."""
    row = {
        "game_id": "g1", "play_id": "p1", "play_status": "ACTIVO", "player_id": player, "player_name": player,
        "position": position, "team": "T", "x_coord": x, "y_coord": y, "speed_mph": 10.0,
        "acceleration_m_s2": 1.0, "heart_rate_bpm": 150, "stamina_pct": 80.0, "timestamp": BASE_MS + ms,
    }
    return tuple((row | changes)[name] for name in TELEMETRY.names)


def events(spark, rows):
    return spark.createDataFrame(rows, TELEMETRY)


def one_second(spark):
    """Two receivers and two defenders, five samples each inside one second."""
    places = {"w1": ("WR", 0.0), "w2": ("WR", 50.0), "c1": ("CB", 10.0), "c2": ("CB", 42.0)}
    return events(
        spark,
        [event(p, role, ms=200 * i, x=x + i, y=float(i)) for p, (role, x) in places.items() for i in range(5)],
    )


def with_record_columns(df):
    return df.select(
        "*",
        F.lit(None).cast("timestamp").alias("kafka_timestamp"),
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
    )
