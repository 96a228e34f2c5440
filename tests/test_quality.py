import pytest
from pyspark.sql import functions as F

from gridpulse.operators import Expectations, Rule
from gridpulse.plans import rules
from gridpulse.plans.rule_history import RuleHistory, write_checked
from gridpulse.session import new_folder

# rule -> (columns, values that satisfy it, values that break it)
CASES = {
    "velocidad_valida": (rules.TELEMETRY_RULES, "speed_mph DOUBLE", [0.0, 30.0, 15.5], [-0.1, 30.1, None]),
    "ritmo_cardiaco_valido": (rules.TELEMETRY_RULES, "heart_rate_bpm INT", [0, 150], [None]),
    "game_id_valido": (rules.GAME_RULES, "game_id STRING", ["g", " "], ["", None]),
    "equipos_validos": (rules.GAME_RULES, "home_team STRING, away_team STRING", [("a", "b"), ("", "b")], [("a", None), (None, "b")]),
    "temporada_coherente": (rules.GAME_RULES, "season INT", [2000, 2026], [1999, 2027, None]),
    "temperatura_logica": (rules.GAME_RULES, "temperature_f INT", [-20, 120], [-21, 121, None]),
    "llaves_jugada_validas": (rules.PLAY_RULES, "play_id STRING, game_id STRING", [("p", "g")], [(None, "g"), ("p", None)]),
    "down_valido": (rules.PLAY_RULES, "down INT", [1, 4], [0, 5, None]),
    "quarter_valido": (rules.PLAY_RULES, "quarter STRING", ["1", "5"], ["0", "6", "OT", None]),
    "distancia_positiva": (rules.PLAY_RULES, "distance_to_first INT", [0, 10], [-1, None]),
    "player_id_valido": (rules.PLAYER_RULES, "player_sk STRING", ["k"], ["", None]),
    "nombre_valido": (rules.PLAYER_RULES, "full_name STRING", ["n", ""], [None]),
    "peso_coherente": (rules.PLAYER_RULES, "weight_lbs INT", [140, 400], [139, 401, None]),
    "estatura_coherente": (rules.PLAYER_RULES, "height_in INT", [60, 90], [59, 91, None]),
}
DROPPING = {
    "velocidad_valida", "ritmo_cardiaco_valido", "game_id_valido", "equipos_validos",
    "llaves_jugada_validas", "player_id_valido", "nombre_valido",
}


def test_every_rule_has_a_case():
    all_rules = [r for e in (rules.TELEMETRY_RULES, rules.GAME_RULES, rules.PLAY_RULES, rules.PLAYER_RULES) for r in e.rules]
    assert {r.name for r in all_rules} == set(CASES)
    assert {r.name for r in all_rules if r.drop} == DROPPING


@pytest.mark.parametrize("name", CASES)
def test_rule_at_its_bounds(spark, name):
    expectations, schema, good, bad = CASES[name]
    rule = next(r for r in expectations.rules if r.name == name)
    df = spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in good + bad], schema)
    only = Expectations((rule,))
    kept = only.keep(df).count()
    assert kept == (len(good) if rule.drop else len(good) + len(bad))
    row = only.metrics(df).first()
    assert (row.rule, row.passed, row.failed) == (name, len(good), len(bad))
    assert row.action == ("drop" if rule.drop else "count")


def test_metrics_per_group_and_of_nothing(spark):
    checks = Expectations((Rule("low", "v < 10", drop=True), Rule("even", "v % 2 = 0")))
    df = spark.range(20).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    found = {(r.g, r.rule): (r.passed, r.failed) for r in checks.metrics(df, by=["g"]).collect()}
    assert found == {(0, "low"): (5, 5), (1, "low"): (5, 5), (0, "even"): (10, 0), (1, "even"): (0, 10)}
    empty = checks.metrics(df.where("v < 0")).collect()
    assert [(r.passed, r.failed) for r in empty] == [(0, 0), (0, 0)]


def test_rules_counted_by_the_write(spark):
    """Kept and dropped rows in folders of their own, counts as ``metrics`` has them, run by run."""
    checks = Expectations((Rule("small", "v < 10", drop=True), Rule("even", "v % 2 = 0"), Rule("known", "g IS NOT NULL", drop=True)))
    df = spark.range(20).select(F.col("id").alias("v"), F.when(F.col("id") % 5 > 0, F.lit("a")).alias("g"))
    history = RuleHistory(spark, new_folder(spark, "history"))
    for run, rows in enumerate((df, df.where("v < 3"), df.where("v < 0")), start=1):
        assert history.next_run() == run
        checked = write_checked(rows, checks, new_folder(spark, "checked"), ["g"])
        history.add(checked.counts, "t", run)
        assert sorted(checked.kept.read().select("v").collect()) == sorted(checks.keep(rows).select("v").collect())
        assert checked.kept.read().count() + checked.dropped.read().count() == rows.count()
        expected = {(r.rule, r.action, r.passed, r.failed) for r in checks.metrics(rows).collect()}
        assert {(r.rule, r.action, r.passed, r.failed) for r in history.read().where(f"run = {run}").collect()} == expected
    history.add_observed({"rows": 7, "small": 2, "even": 0, "known": 1}, checks, "t", 2)
    again = {r.rule: (r.passed, r.failed) for r in history.read().where("run = 2").collect()}
    assert again == {"small": (5, 2), "even": (7, 0), "known": (6, 1)} and history.read().count() == 9
