"""Batch and streaming silver: duplicates, event time, late rows, restarts."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fixtures import BASE_MS, event, events, one_second, with_record_columns
from gridpulse.functions import event_time
from gridpulse.operators import dedup_batch, first_per_group
from gridpulse.plans.bronze import bronze_from_records
from gridpulse.plans.separation import separation_fact
from gridpulse.plans.silver import EVENT_KEYS, clean_metrics, silver_batch, silver_stream
from gridpulse.schemas import TELEMETRY
from gridpulse.session import new_folder
from gridpulse.sources import encode_events
from gridpulse.streaming import dedup_stream, write_stream
from gridpulse.streaming.late import ROCKS, STORE


HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def streamed_silver(spark, df, **options):
    source, out = new_folder(spark, "bronze"), new_folder(spark, "silver")
    df.write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    write_stream(silver_stream(stream, **options), out, new_folder(spark, "state"))
    return spark.read.parquet(out)


def test_one_second_keeps_five_samples_in_batch_and_one_in_stream(spark):
    bronze = with_record_columns(one_second(spark))
    batch, stream = silver_batch(bronze), streamed_silver(spark, bronze)
    assert batch.count() == 20 and stream.count() == 4
    assert batch.columns == stream.columns
    assert batch.select(*EVENT_KEYS).distinct().exceptAll(stream.select(*EVENT_KEYS)).isEmpty()
    # The fact has one row per receiver and second either way, and one per sample with milliseconds.
    assert separation_fact(batch).count() == 2
    assert separation_fact(stream).count() == 2
    assert separation_fact(silver_batch(bronze, precision="millis")).count() == 10


def test_fact_on_batch_silver_is_the_minimum_over_the_second(spark):
    fact = {r.offensive_player_sk: r.separation_yards for r in separation_fact(silver_batch(one_second(spark))).collect()}
    # w1 runs from x=0 to 4, c1 from 10 to 14: closest are w1's last and c1's first sample, y 4 against 0.
    assert sorted(fact.values()) == sorted([((10 - 4) ** 2 + 4**2) ** 0.5, ((50 - 46) ** 2 + 4**2) ** 0.5])


def test_columns_of_silver(spark):
    silver = silver_batch(bronze_from_records(as_records(one_second(spark))))
    assert set(silver.columns) == {*one_second(spark).columns, "ingested_at", "silver_processed_at"}
    assert silver.schema["timestamp"].dataType.simpleString() == "timestamp"


def as_records(df):
    return encode_events(df).select(
        "*", F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(0).alias("offset"), F.current_timestamp().alias("timestamp")
    )


def test_metrics_are_typed_and_rounded(spark):
    df = spark.createDataFrame(
        [("7.5", "150", "1.005", 1_000), ("x", "y", None, None)],
        "speed_mph STRING, heart_rate_bpm STRING, acceleration_m_s2 STRING, timestamp BIGINT",
    )
    good, bad = clean_metrics(df).collect()
    assert (good.speed_mph, good.heart_rate_bpm, good.acceleration_m_s2) == (7.5, 150, 1.01)
    assert (bad.speed_mph, bad.heart_rate_bpm, bad.acceleration_m_s2, bad.timestamp) == (None, None, None, None)


def test_rules_come_after_dedup(spark):
    twins = [event("a", "WR", speed_mph=99.0), event("a", "WR", speed_mph=5.0), event("b", "WR", heart_rate_bpm=None)]
    df = with_record_columns(events(spark, twins)).withColumn("offset", F.when(F.col("speed_mph") > 50, 1).otherwise(2))
    assert silver_batch(df, order_by=["offset"]).count() == 0
    last = silver_batch(df.withColumn("offset", -F.col("offset")), order_by=["offset"])
    assert [r.speed_mph for r in last.collect()] == [5.0]


def test_first_per_group_matches_row_number(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "q"), ("b", 5, "r"), (None, 1, "n"), (None, 0, "m"), ("c", None, None)],
        "k STRING, o INT, v STRING",
    )
    expected = [("a", 1, "y"), ("b", 5, "r"), (None, 0, "m"), ("c", None, None)]
    assert sorted(map(tuple, first_per_group(df, ["k"], ["o"]).collect()), key=str) == sorted(expected, key=str)
    assert dedup_batch(df, ["k"], ["o"]).columns == df.columns
    assert dedup_batch(df, ["k"]).count() == 4


row = st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 2), st.integers(0, 3))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=20))
def test_dedup_twice_changes_nothing(spark, rows):
    df = spark.createDataFrame(rows, "k STRING, o INT, v INT")
    once = dedup_batch(df, ["k"], ["o", "v"])
    assert sorted(map(str, once.collect())) == sorted(map(str, dedup_batch(once, ["k"], ["o", "v"]).collect()))
    assert once.count() == len({r[0] for r in rows})


def test_stream_over_three_runs_drops_late_rows_only(spark):
    source, out, state = (new_folder(spark, n) for n in ("in", "out", "state"))

    def arrive(*samples):
        rows = [event(p, "WR", ms=ms) for p, ms in samples]
        events(spark, rows).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events(spark, rows).schema).parquet(source)
        run = write_stream(silver_stream(stream), out, state)
        return run, spark.read.parquet(out).count()

    run, total = arrive(("x", 0), ("x", 200), ("y", 0), ("x", 0))
    assert (run.observed["timed"]["rows"], run.late_rows, total) == (4, 0, 2)
    run, total = arrive(("x", 300), ("x", 180_000))
    assert (run.late_rows, total) == (0, 3)
    # The watermark now stands at 120 s: the first of these is too late, the second is not.
    run, total = arrive(("x", 1_000), ("x", 125_000))
    assert (run.late_rows, total) == (1, 4)
    assert run.observed["silver_rules"]["rows"] == 1


def test_stream_equals_batch_when_nothing_is_late(spark):
    rows = [event(f"p{i % 7}", "WR", ms=1000 * (i % 13)) for i in range(200)]
    df = with_record_columns(events(spark, rows))
    expected = silver_batch(df).select(*EVENT_KEYS).distinct()
    for spread_by in (None, "offset"):
        found = streamed_silver(spark, df, spread_by=spread_by).select(*EVENT_KEYS)
        assert found.count() == expected.count() and found.exceptAll(expected).isEmpty()


def test_rows_without_event_time_stay_and_leave_no_state(spark):
    source, out, state = (new_folder(spark, n) for n in ("in", "out", "state"))
    for i in range(3):
        rows = [event("n", "WR", timestamp=None)] * 5 + [event("x", "WR", ms=120_000 * i)]
        events(spark, rows).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events(spark, rows).schema).parquet(source)
        run = write_stream(silver_stream(stream), out, state)
        assert run.observed["untimed"]["rows"] == 5 and run.late_rows == 0
    found = spark.read.parquet(out).groupBy(F.col("timestamp").isNull().alias("untimed")).count().collect()
    assert {r.untimed: r["count"] for r in found} == {True: 15, False: 3}


def test_state_is_off_the_heap_where_the_session_names_no_store(spark, tmp_path):
    """And the session's own settings are as before."""
    named = spark.conf.get(STORE)
    for chosen in (None, HEAP):
        spark.conf.unset(STORE) if chosen is None else spark.conf.set(STORE, chosen)
        try:
            folder = tmp_path / str(chosen)
            one_second(spark).write.parquet(f"{folder}/in")
            stream = spark.readStream.schema(TELEMETRY).parquet(f"{folder}/in")
            write_stream(silver_stream(stream), f"{folder}/out", f"{folder}/state")
            assert spark.conf.get(STORE, None) == chosen
            assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", None) is None
        finally:
            spark.conf.set(STORE, named)
        used = json.loads((folder / "state/offsets/0").read_text().splitlines()[1])["conf"]
        assert used[STORE] == (chosen or ROCKS)
        assert spark.read.parquet(f"{folder}/out").count() == 4


def test_bad_times_become_null(spark):
    values = ["1700000000000", "1700000000000000000", "soon", None, "-1", "99999999999999999999"]
    df = spark.createDataFrame([(v,) for v in values], "t STRING")
    seconds = [r[0] for r in df.select(F.unix_seconds(event_time("t"))).collect()]
    assert seconds == [1_700_000_000, None, None, None, 0, None]
    numbers = df.select(F.col("t").try_cast("bigint").alias("t"))
    assert [r[0] for r in numbers.select(F.unix_millis(event_time("t", "millis"))).collect()] == [1_700_000_000_000, None, None, None, -1, None]


def test_stream_dedup_needs_event_time_in_its_keys(spark):
    import pytest

    with pytest.raises(ValueError):
        dedup_stream(spark.createDataFrame([(1,)], "k INT"), ["k"], "timestamp")


def test_base_is_a_whole_second():
    assert BASE_MS % 1000 == 0
