"""Gold kept by arrivals: equal to a recomputed one, untouched games' files unchanged, repeats harmless."""

import os

import pytest
from pyspark.sql import functions as F

from fixtures import event, events
from gridpulse.operators.layout import stream_layout
from gridpulse.plans.gold import PLAY_KEYS, SAMPLES, play_histories, play_trajectory, player_features, player_histories
from gridpulse.plans.incremental import IncrementalGold
from gridpulse.plans.pipeline import run
from gridpulse.plans.silver import clean_metrics
from gridpulse.session import new_folder
from test_pipeline import arrive, bronze

ARRIVALS = [
    [event(f"p{i % 5}", "WR", ms=1000 * i, game_id=f"g{i % 3}", play_id=f"q{i % 4}", speed_mph=i / 4, acceleration_m_s2=i / 8) for i in range(60)],
    # One game again, with rows before, between and after the earlier ones, and a game without id.
    [event(f"p{i % 7}", "CB", ms=700 * i - 5000, game_id="g1", play_id="q1", acceleration_m_s2=None if i % 3 else 2.5) for i in range(40)]
    + [event("x", "WR", ms=i, game_id=None, play_id=None, heart_rate_bpm=None, speed_mph=None) for i in range(4)],
    [event("x", "WR", ms=10 + i, game_id=None, play_id=None, heart_rate_bpm=100 + i) for i in range(3)]
    + [event(None, "WR", ms=5, game_id="g9", play_id="q0")],
]
REBUILT = {
    "player_features": player_features, "play_trajectory": play_trajectory,
    "player_histories": player_histories, "play_histories": play_histories,
}


def files(path):
    found = {}
    for folder, _, names in os.walk(path.removeprefix("file:")):
        for n in names:
            if n.endswith(".parquet"):
                found.setdefault(os.path.relpath(folder, path.removeprefix("file:")), set()).add(n)
    return found


def plain(df):
    return sorted(str(r.asDict(True)) for r in df.select(sorted(c for c in df.columns if c != "feature_timestamp")).collect())


@pytest.mark.parametrize("limit", [200_000, 16])
def test_arrivals_equal_a_rebuild_and_leave_other_games_alone(spark, limit):
    base = new_folder(spark, "gold")
    gold, so_far, touched = IncrementalGold(spark, base, limit=limit), None, [None, {"game_id=g0", "game_id=g2"}, None]
    for i, rows in enumerate(ARRIVALS):
        new = clean_metrics(events(spark, rows))
        so_far = new if so_far is None else so_far.unionByName(new)
        tables = gold.tables(new.schema)
        before = {name: files(layer.path) for name, layer in tables.items()}
        gold.update(new, i)
        for name, layer in tables.items():
            assert plain(layer.read()) == plain(REBUILT[name](so_far, limit=limit)), name
            after = files(layer.path)
            for part in touched[i] or ():
                assert before[name][part] == after[part]
    # The last arrival again: nothing changes.
    gold.update(clean_metrics(events(spark, ARRIVALS[-1])), len(ARRIVALS) - 1)
    for name, layer in gold.tables(so_far.schema).items():
        assert plain(layer.read()) == plain(REBUILT[name](so_far, limit=limit))


def test_many_games_are_joined(spark, monkeypatch):
    monkeypatch.setattr("gridpulse.plans.incremental.NAMED_GAMES", 2)
    gold = IncrementalGold(spark, new_folder(spark, "gold"))
    new = clean_metrics(events(spark, ARRIVALS[0] + ARRIVALS[2]))
    tables = gold.tables(new.schema)
    gold.update(new.where("FALSE"), 0)
    assert tables["play_trajectory"].read().isEmpty()
    gold.update(new, 1)
    assert plain(tables["play_trajectory"].read()) == plain(play_trajectory(new))


def test_runs_of_the_pipeline(spark):
    folder, out = new_folder(spark, "records"), new_folder(spark, "out")
    arrive(spark, folder, [event("a", "WR"), event("b", "CB", game_id="g2")])
    first = run(spark, bronze(spark, folder), out, gold="incremental")
    kept = files(first.player_features.path)["game_id=g2"]
    arrive(spark, folder, [event("a", "WR", ms=2000), event("c", "WR", ms=3000)])
    second = run(spark, bronze(spark, folder), out, gold="incremental")
    assert (first.gold_run.batches, second.gold_run.batches) == (1, 1)
    assert files(second.player_features.path)["game_id=g2"] == kept
    found = {(r.game_id, r.player_id): len(r.acceleration_history_array) for r in second.player_features.read().collect()}
    assert found == {("g1", "a"): 2, ("g2", "b"): 1, ("g1", "c"): 1}
    again = run(spark, bronze(spark, folder), out, gold="incremental")
    assert again.gold_run.input_rows == 0 and plain(again.player_features.read()) == plain(second.player_features.read())
    with pytest.raises(ValueError):
        run(spark, bronze(spark, folder), out, silver="batch", gold="incremental")


@pytest.mark.parametrize("precision", ["second", "millis"])
def test_a_hot_play_is_cut_into_many_cells(spark, precision):
    """A third of all rows in one play of two seconds: no cell that is numbered in one task has many of them."""
    rows = [event(f"p{i % 22}", "WR", ms=i * 2, acceleration_m_s2=float(i % 9)) for i in range(1000)]
    rows += [event(f"p{i % 22}", "WR", ms=i, game_id=f"g{i % 50}", play_id="other") for i in range(2000)]
    silver = clean_metrics(events(spark, rows), precision)
    cells = silver.where("play_id = 'p1'").groupBy(*[c.alias(f"c{i}") for i, c in enumerate(SAMPLES.cell())]).count()
    largest = cells.agg(F.max("count"), F.count("*")).first()
    assert largest[0] <= (500 if precision == "millis" else 30) and largest[1] >= 2
    arrays = play_histories(silver).where("play_id = 'p1'").first().telemetry_history_array
    assert len(arrays) == 1000 and [(r.timestamp, r.player_id) for r in arrays] == sorted((r.timestamp, r.player_id) for r in arrays)
    assert PLAY_KEYS == ("game_id", "play_id")


def test_a_stream_writes_few_files_for_a_game(spark):
    """Silver's files depend on its games and an arrival's size, not on games times shuffle partitions."""
    rows = [event(f"p{i}", "WR", ms=1000 * i, game_id=f"g{i % 3}") for i in range(600)]
    rows += [event("none", "WR", ms=1000 * i, game_id=None) for i in range(5)]
    folder, before = new_folder(spark, "records"), spark.conf.get("spark.sql.shuffle.partitions")
    arrive(spark, folder, rows)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        silver = run(spark, bronze(spark, folder), new_folder(spark, "out"), gold="incremental").silver
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r.game_id: r["count"] for r in silver.read().groupBy("game_id").count().collect()} == {"g0": 200, "g1": 200, "g2": 200, None: 5}
    found = files(silver.path)
    assert len(found) == 4 and all(1 <= len(names) <= 8 for names in found.values())
    assert len(found["game_id=g0"]) > 1


def test_gathered_rows_may_hold_maps(spark):
    df = spark.sql("SELECT id % 2 AS game, map('a', id) AS m, array(map('b', id)) AS n, named_struct('x', id) AS s FROM range(100)")
    assert sorted(r.game for r in stream_layout(df, ["game"]).collect()) == [0] * 50 + [1] * 50
