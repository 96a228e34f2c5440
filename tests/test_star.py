"""Dimensions, separation facts and the matchup report."""

from hashlib import md5

import pytest
from pyspark.sql import functions as F

from fixtures import event, events
from gridpulse.functions import event_time
from gridpulse.operators import star_join
from gridpulse.operators.star import Dimension
from gridpulse.plans.dimensions import DIMENSIONS, GAME, PLAY, PLAYER
from gridpulse.plans.reports import matchup_report
from gridpulse.plans.separation import separation_fact


def digest(text):
    return md5(text.encode()).hexdigest()


def test_game_dimension_from_a_dirty_csv(spark, tmp_path):
    lines = [
        ",".join(GAME.csv_schema.names),
        "g1,2024,1,A,B,Park,grass,dry,70",
        "g2,twenty,2,A,B,Park,grass,dry,hot",
        ",2024,1,A,B,Park,grass,dry,70",
        "g3,2024,1,,B,Park,grass,dry,70",
        "g4,1990,1,A,B,Park,grass,dry,-40",
    ]
    (tmp_path / "dim_game.csv").write_text("\n".join(lines) + "\n")
    bronze = GAME.bronze(spark, f"{tmp_path}/")
    gold = {r.game_id: r for r in GAME.gold(GAME.silver(bronze)).collect()}
    assert set(gold) == {"g1", "g2", "g4"}
    assert (gold["g1"].game_sk, gold["g1"].season, gold["g1"].temperature_f) == (digest("g1"), 2024, 70)
    assert (gold["g2"].season, gold["g2"].week, gold["g2"].temperature_f) == (None, 2, None)
    failed = {r.rule: r.failed for r in GAME.expectations.metrics(GAME.unchecked(bronze)).collect()}
    assert failed == {"game_id_valido": 1, "equipos_validos": 1, "temporada_coherente": 2, "temperatura_logica": 2}


def test_play_dimension(spark):
    rows = [("p1", "g1", "OT", "3", "10", "zone", "run"), ("p2", None, "1", "x", "-1", None, None), ("p3", "g1", "2", None, None, None, None)]
    gold = {r.play_id: r for r in PLAY.gold(PLAY.silver(spark.createDataFrame(rows, PLAY.csv_schema))).collect()}
    assert set(gold) == {"p1", "p3"}
    assert gold["p1"].play_sk == digest("g1||p1")
    assert (gold["p1"].quarter, gold["p1"].down, gold["p1"].distance_to_first) == ("OT", 3, 10)


def test_player_dimension_hashes_its_key_in_place(spark):
    rows = [
        ("04", "Rice", "T", "WR", "70", "200", "c", "2020"), ("", "Empty", "T", "WR", "tall", "200", "c", "2020"),
        (None, "NoId", "T", "WR", "70", "200", "c", "2020"), ("05", None, "T", "WR", "70", "200", "c", "2020"),
    ]
    silver = PLAYER.silver(spark.createDataFrame(rows, PLAYER.csv_schema))
    gold = {r.full_name: r for r in PLAYER.gold(silver).collect()}
    # The rule sees the hash: an empty id passes, a missing one does not.
    assert set(gold) == {"Rice", "Empty"}
    assert gold["Rice"].player_sk == digest("04") and gold["Empty"].height_in is None
    assert isinstance(gold["Rice"].draft_year, str) and "ingestion_timestamp" in silver.columns


def test_published_columns():
    assert {name: len(plan.published) for name, plan in DIMENSIONS.items()} == {"game": 10, "play": 8, "player": 8}


@pytest.fixture
def two_games(spark):
    rows = [
        event("w", "WR", game_id="g1", x=0.0), event("c1", "CB", game_id="g1", x=10.0),
        event("w", "WR", game_id="g2", x=0.0), event("c2", "CB", game_id="g2", x=2.0),
        event("v", "WR", game_id="g2", x=50.0), event("q", "QB", game_id="g1", x=0.0),
    ]
    return events(spark, rows).withColumn("timestamp", event_time("timestamp"))


def test_games_meet_unless_the_game_is_matched(two_games):
    def found(**options):
        return {(r.game_id, r.offensive_player_sk): (r.defensive_player_sk, r.separation_yards) for r in separation_fact(two_games, **options).collect()}

    w, v, c1, c2 = map(digest, ("w", "v", "c1", "c2"))
    assert found() == {("g1", w): (c2, 2.0), ("g2", w): (c2, 2.0), ("g2", v): (c1, 40.0)}
    apart = {("g1", w): (c1, 10.0), ("g2", w): (c2, 2.0), ("g2", v): (c2, 48.0)}
    assert found(match_on=("game_id", "play_id", "timestamp")) == apart
    assert found(match_on=("game_id", "play_id", "timestamp"), small_group=0) == apart
    assert found(game_id="TODOS") == found()
    assert found(game_id="g1") == {("g1", w): (c1, 10.0)}
    assert found(offense="QB") == {("g1", digest("q")): (c2, 2.0)}


def test_fact_columns_and_keys(two_games):
    fact = separation_fact(two_games)
    assert fact.columns == [
        "game_id", "play_id", "timestamp", "separation_yards", "game_sk", "play_sk", "offensive_player_sk", "defensive_player_sk",
    ]
    row = fact.where("game_id = 'g1'").first()
    assert (row.game_sk, row.play_sk) == (digest("g1"), digest("g1||p1"))


def test_star_join_uses_one_table_in_two_roles(spark):
    fact = spark.createDataFrame([("a", "b", 1), ("b", "a", 2), ("a", "z", 3), (None, "a", 4)], "f STRING, t STRING, v INT")
    names = spark.createDataFrame([("a", "Ann"), ("b", "Bob")], "k STRING, name STRING")
    joined = star_join(fact, [Dimension(names, "k", "f", {"sender": "name"}), Dimension(names, "k", "t", {"receiver": "name"})])
    assert joined.columns == ["f", "t", "v", "sender", "receiver"]
    assert {(r.sender, r.receiver, r.v) for r in joined.collect()} == {("Ann", "Bob", 1), ("Bob", "Ann", 2)}


def report_inputs(spark):
    """w1-c1 meet in three third-down plays, w2-c1 in two; a fourth-down play and a huddle stay out."""
    fact = [("w1", "c1", p, s) for p, s in (("p1", 1.0), ("p1", 2.0), ("p2", 3.0), ("p3", 6.5), ("p3", None), ("p4", 90.0), ("huddle", 90.0))]
    fact += [("w2", "c1", p, 9.0) for p in ("p1", "p2")]
    fact += [("w3", "c1", p, None) for p in ("p1", "p2", "p3")]
    facts = spark.createDataFrame(fact, "offensive_player_sk STRING, defensive_player_sk STRING, play_sk STRING, separation_yards DOUBLE")
    players = spark.createDataFrame([(k, k.upper(), "T") for k in ("w1", "w2", "w3", "c1")], "player_sk STRING, full_name STRING, team STRING")
    plays = spark.createDataFrame([("p1", 3), ("p2", 3), ("p3", 3), ("p4", 4), ("p5", None)], "play_sk STRING, down INT")
    return facts, players, plays


def test_matchup_report(spark):
    rows = matchup_report(*report_inputs(spark)).collect()
    assert [tuple(r) for r in rows] == [("W1", "T", "C1", 3.13, 6.5, 3), ("W3", "T", "C1", None, None, 3)]
    assert rows[0].__fields__ == [
        "receptor_ofensivo", "equipo", "esquinero_defensor",
        "promedio_separacion_yardas", "maxima_separacion_yardas", "total_jugadas_analizadas",
    ]
    assert [r.receptor_ofensivo for r in matchup_report(*report_inputs(spark), min_plays=2).collect()] == ["W2", "W1", "W3"]
    assert matchup_report(*report_inputs(spark), min_plays=1, top_n=1).first().receptor_ofensivo == "W2"
    assert matchup_report(*report_inputs(spark), down=4, min_plays=1).first().promedio_separacion_yardas == 90.0


def test_report_combines_no_groups_where_it_reads(spark):
    """The instants are spread by pair and play before the first aggregate, so that a file's groups are not one task's."""
    plan = matchup_report(*report_inputs(spark))._jdf.queryExecution().sparkPlan().toString()
    aggregates = [i for i, line in enumerate(plan.splitlines()) if "HashAggregate(" in line]
    spread = [i for i, line in enumerate(plan.splitlines()) if "REPARTITION_BY_COL" in line]
    assert spread and aggregates[-1] < spread[0]


def test_report_counts_plays_of_namesakes_once(spark):
    facts, players, plays = report_inputs(spark)
    namesakes = players.withColumn("full_name", F.when(F.col("player_sk").startswith("w"), "W").otherwise("C"))
    row = matchup_report(facts, namesakes, plays).first()
    assert (row.total_jugadas_analizadas, row.promedio_separacion_yardas) == (3, round((1 + 2 + 3 + 6.5 + 9 + 9) / 6, 2))
