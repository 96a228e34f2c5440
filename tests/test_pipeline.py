"""The incremental run: two arrivals, a repeat, a full refresh, and the batch silver."""

import pytest
from pyspark.sql import functions as F

from fixtures import event, events
from gridpulse.plans.bronze import bronze_from_records
from gridpulse.plans.pipeline import batch_silver_metrics, run
from gridpulse.session import new_folder
from gridpulse.schemas import KAFKA_RECORD
from gridpulse.sources import encode_events


def arrive(spark, folder, rows):
    records = encode_events(events(spark, rows)).select(
        "key", "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp"),
    )
    records.coalesce(1).write.mode("append").parquet(folder)


def bronze(spark, folder):
    return bronze_from_records(spark.readStream.schema(KAFKA_RECORD).parquet(folder))


@pytest.mark.parametrize("silver", ["stream", "batch"])
def test_runs_are_incremental(spark, silver):
    folder, out = new_folder(spark, "records"), new_folder(spark, "out")
    arrive(spark, folder, [event("a", "WR"), event("a", "WR"), event("b", "CB", speed_mph=99.0), event("c", "CB", ms=400)])
    first = run(spark, bronze(spark, folder), out, silver=silver)
    assert (first.bronze_run.input_rows, first.bronze.read().count(), first.silver.read().count()) == (4, 4, 2)
    play = first.play_trajectory.read().first()
    assert (play.players_tracked, len(play.telemetry_history_array)) == (2, 2)

    again = run(spark, bronze(spark, folder), out, silver=silver)
    assert (again.bronze_run.input_rows, again.silver.read().count()) == (0, 2)

    arrive(spark, folder, [event("d", "WR", ms=1000, game_id="g2"), event("a", "WR")])
    second = run(spark, bronze(spark, folder), out, silver=silver)
    assert (second.bronze_run.input_rows, second.bronze.read().count(), second.silver.read().count()) == (2, 6, 3)
    assert {(r.game_id, r.player_id) for r in second.player_features.read().collect()} == {("g1", "a"), ("g1", "c"), ("g2", "d")}
    if silver == "stream":
        assert first.silver_run.observed["silver_rules"]["velocidad_valida"] == 1
    else:
        assert second.silver_run is None
        failed = {r.rule: r.failed for r in batch_silver_metrics(second.bronze.read()).collect()}
        assert failed == {"velocidad_valida": 1, "ritmo_cardiaco_valido": 0}

    fresh = run(spark, bronze(spark, folder), out, silver=silver, full_refresh=True)
    assert fresh.bronze.path != second.bronze.path
    assert (fresh.bronze_run.input_rows, fresh.silver.read().count()) == (6, 3)
    later = run(spark, bronze(spark, folder), out, silver=silver)
    assert (later.bronze.path, later.bronze_run.input_rows) == (fresh.bronze.path, 0)


def test_unknown_silver_is_refused(spark):
    with pytest.raises(ValueError):
        run(spark, spark.createDataFrame([(1,)], "a INT"), "nowhere", silver="gold")
