"""Rollups, also of groups too large for one row."""

import statistics

import pytest
from pyspark.sql import functions as F

from fixtures import event, events, one_second
from gridpulse.operators.groups import ordered_blocks
from gridpulse.plans.gold import play_histories, play_trajectory, player_features, player_histories
from gridpulse.plans.scoring import array_features, play_features
from gridpulse.plans.silver import clean_metrics


def test_player_features(spark):
    rows = [
        event("a", "WR", ms=2000, speed_mph=10.0, heart_rate_bpm=150, acceleration_m_s2=2.0),
        event("a", "WR", ms=1000, speed_mph=11.25, heart_rate_bpm=151, acceleration_m_s2=1.0),
        event("a", "WR", ms=3000, speed_mph=12.0, heart_rate_bpm=170, acceleration_m_s2=None),
        event("a", "WR", ms=0, game_id="g2", speed_mph=3.0),
        event(None, "WR", ms=0, speed_mph=4.0),
    ]
    found = {(r.game_id, r.player_id): r for r in player_features(clean_metrics(events(spark, rows))).collect()}
    assert set(found) == {("g1", "a"), ("g2", "a"), ("g1", None)}
    row = found["g1", "a"]
    assert (row.avg_speed_mph, row.max_speed_today, row.avg_heart_rate, row.peak_heart_rate) == (11.08, 12.0, 157.0, 170)
    assert row.acceleration_history_array == [1.0, 2.0]
    assert row.history_parts == 1 and row.feature_timestamp is not None


def test_play_trajectory(spark):
    rows = [event("b", "WR", ms=1000), event("a", "CB", ms=1000, acceleration_m_s2=None), event("a", "CB", ms=0, speed_mph=20.0), event(None, "CB")]
    row = play_trajectory(clean_metrics(events(spark, rows))).first()
    assert (row.max_speed_in_play, row.players_tracked) == (20.0, 2)
    assert [s.player_id for s in row.telemetry_history_array] == [None, "a", "a", "b"]
    assert row.telemetry_history_array[2].acceleration_m_s2 is None
    assert row.telemetry_history_array[0].__fields__ == ["player_id", "timestamp", "speed_mph", "acceleration_m_s2"]


@pytest.fixture(scope="module")
def uneven(spark):
    """One player and play with most of the rows, a NULL player among them, and copies of one row."""
    rows = [event("hot", "WR", ms=1000 * i, speed_mph=float(i % 20), acceleration_m_s2=i / 4, heart_rate_bpm=100 + i % 50) for i in range(500)]
    rows += [event("hot", "WR", ms=5000, acceleration_m_s2=1.25)] * 60
    rows += [event(f"p{i}", "CB", ms=1000 * i, play_id=f"p{i % 9}", acceleration_m_s2=None) for i in range(90)]
    rows += [event(None, "CB", ms=i, game_id="g2", play_id=None) for i in range(70)]
    return clean_metrics(events(spark, rows)).repartition(6).cache()


CASES = [
    (player_features, player_histories, ("game_id", "player_id"), "acceleration_history_array"),
    (play_trajectory, play_histories, ("game_id", "play_id"), "telemetry_history_array"),
]


def by_part(rows, keys, array):
    return {(*(r[k] for k in keys), r.history_part): list(map(str, r[array])) for r in rows}


@pytest.mark.parametrize(("rollup", "parts_of", "keys", "array"), CASES)
def test_one_row_a_group_and_histories_in_parts(uneven, rollup, parts_of, keys, array):
    single = {tuple(r[k] for k in keys): r for r in rollup(uneven, stamp=False).collect()}
    assert {r.history_parts for r in single.values()} <= {0, 1}
    split = rollup(uneven, limit=64, stamp=False).collect()
    assert len(split) == len(single)
    parts = by_part(parts_of(uneven, limit=64).collect(), keys, array)
    assert max(map(len, parts.values())) == 64
    for r in split:
        key = tuple(r[k] for k in keys)
        whole, n = single[key], r.history_parts
        assert all(r[c] == whole[c] for c in r.__fields__ if c not in (array, "history_parts"))
        own = [parts.pop((*key, i)) for i in range(n)]
        assert all(len(p) == 64 for p in own[:-1])
        assert [x for p in own for x in p] == list(map(str, whole[array]))
        assert list(map(str, r[array])) == (own[0] if own else [])
    assert not parts


@pytest.mark.parametrize(("rollup", "parts_of", "keys", "array"), CASES)
@pytest.mark.parametrize("limit", [559, 560, 561])
def test_parts_depend_on_the_data_alone(spark, uneven, rollup, parts_of, keys, array, limit):
    """Around the size of the hot group, with 2, 8 and 16 shuffle partitions."""
    found = []
    try:
        for n in (2, 8, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            found.append(by_part(parts_of(uneven, limit=limit).collect(), keys, array))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1] == found[2]


def test_features_of_split_plays_equal_those_of_whole_plays(uneven):
    keys = ("game_id", "play_id")
    names = ["mean_vel", "max_vel", "min_vel", "mean_acc", "max_acc", "min_acc"]
    plain = array_features(play_trajectory(uneven, stamp=False)).select(*keys, *names).collect()
    split = play_features(play_histories(uneven, limit=64)).select(*keys, *names).collect()
    a, b = ({tuple(r[k] for k in keys): [r[n] for n in names] for r in rows} for rows in (plain, split))
    assert a.keys() == b.keys()
    for key in a:
        assert a[key] == pytest.approx(b[key])


def test_small_histories_are_not_gathered_in_one_task(spark):
    """Arrays compress well, and adaptive execution counts compressed bytes."""
    rows = [event(f"p{i}", "WR", ms=1000 * i, play_id=f"play{i % 40}") for i in range(400)]
    parts = play_histories(clean_metrics(events(spark, rows)))
    assert parts.count() == 40
    assert parts.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_building_a_rollup_runs_no_job(spark):
    silver = clean_metrics(one_second(spark))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "")
    for build in (player_features, play_trajectory, player_histories, play_histories):
        build(silver)
    assert not tracker.getJobIdsForGroup("build")
    spark.sparkContext._jsc.clearJobGroup()


def test_ordered_blocks_spread_copies_and_keep_order(spark):
    df = spark.range(4000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id") % 50).alias("v")).repartition(8)
    # Adaptive execution would merge partitions this small again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    blocks = ordered_blocks(df, ["v"], 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = blocks.frame.groupBy("_block").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("_block").collect()
    assert sum(r.n for r in rows) == 4000 and max(r.n for r in rows) <= 16
    assert all(a.hi <= b.lo for a, b in zip(rows, rows[1:]))
    assert rows[-1]["_block"] < blocks.span
    tasks = blocks.frame.where("v = 7").select(F.spark_partition_id()).distinct().count()
    assert tasks > 1
    assert ordered_blocks(df.where("v < 0"), ["v"], 16).frame.count() == 0


def test_rounded_mean_is_half_up(spark):
    rows = [event("a", "WR", ms=i, speed_mph=s) for i, s in enumerate((1.0, 1.25, 1.125))]
    assert player_features(clean_metrics(events(spark, rows))).first().avg_speed_mph == 1.13
    assert statistics.mean((1.0, 1.25, 1.125)) == 1.125
