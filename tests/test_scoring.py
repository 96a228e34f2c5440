import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from gridpulse.plans.forest_table import NODES, forest_nodes, predict_by_table
from gridpulse.plans.scoring import (
    PlayScorer,
    array_features,
    balance_single_row,
    feature_names,
    predict,
    random_labels,
    train,
)
from gridpulse.session import new_folder

TRAJECTORY = (
    "game_id STRING, play_id STRING, telemetry_history_array "
    "ARRAY<STRUCT<player_id: STRING, timestamp: TIMESTAMP, speed_mph: DOUBLE, acceleration_m_s2: DOUBLE>>"
)


def samples(*pairs):
    return [("x", None, speed, acceleration) for speed, acceleration in pairs]


def test_array_features(spark):
    rows = [
        ("g", "two", samples((1.0, -1.0), (3.0, 2.0))), ("g", "one", samples((4.0, 0.5))), ("g", "empty", []),
        ("g", "missing", None), ("g", "hole", samples((1.0, None), (None, 2.0))),
    ]
    found = {r.play_id: [r[n] for n in feature_names()] for r in array_features(spark.createDataFrame(rows, TRAJECTORY)).collect()}
    assert feature_names() == ["mean_vel", "max_vel", "min_vel", "mean_acc", "max_acc", "min_acc"]
    assert found == {
        "two": [2.0, 3.0, 1.0, 0.5, 2.0, -1.0], "one": [4.0, 4.0, 4.0, 0.5, 0.5, 0.5],
        "empty": [0.0] * 6, "missing": [0.0] * 6, "hole": [0.0, 1.0, 1.0, 0.0, 2.0, 2.0],
    }


def test_single_row_is_balanced(spark):
    one = spark.createDataFrame([(1.0, 1)], "f DOUBLE, label INT")
    assert sorted(r.label for r in balance_single_row(one).collect()) == [0, 1]
    assert balance_single_row(one.union(one)).count() == 2
    assert balance_single_row(one.where("f > 9")).count() == 0


def test_random_labels_are_seeded_and_mixed(spark):
    df = spark.range(200)
    first = [r.label for r in random_labels(df, 5).collect()]
    assert set(first) == {0, 1} and first == [r.label for r in random_labels(df, 5).collect()]


@pytest.fixture(scope="module")
def plays(spark):
    rows = [("g", f"p{i}", samples((float(i % 10), 1.0), (float(i % 10) + 1, 2.0))) for i in range(60)]
    return spark.createDataFrame(rows, TRAJECTORY)


def test_forest_learns_a_label_and_scores(spark, plays, tmp_path):
    features = array_features(plays).withColumn("won", (F.col("max_vel") > 5).cast("int"))
    model = train(features, label="won", seed=3)
    forest = model.stages[-1]
    assert forest.getNumTrees == 100 and forest.getMaxDepth() == 5
    scored = predict(model, features)
    assert scored.columns == ["game_id", "play_id", "ml_win_probability_pct", "estrategia"]
    rows = {r.play_id: r for r in scored.collect()}
    assert len(rows) == 60
    assert rows["p9"].ml_win_probability_pct >= 65 and rows["p9"].estrategia == "Alta Confianza"
    assert rows["p0"].ml_win_probability_pct < 40 and rows["p0"].estrategia == "Baja Confianza"
    model.write().overwrite().save(str(tmp_path / "model"))
    again = predict(PipelineModel.load(str(tmp_path / "model")), features)
    assert {r.play_id: r.ml_win_probability_pct for r in again.collect()} == {k: r.ml_win_probability_pct for k, r in rows.items()}


def test_forest_as_a_table_scores_the_same(spark):
    """On inputs of many values, so that trees differ; rows with NaN or NULL are skipped by either."""
    data = spark.range(400).select(
        F.col("id").alias("play_id"), F.lit("g").alias("game_id"),
        ((F.col("id") * 37) % 101 / 7).alias("a"), ((F.col("id") * 61) % 89 / 3).alias("b"), ((F.col("id") * 13) % 29 - 5.5).alias("c"),
    ).withColumn("won", ((F.col("a") + F.col("b") + F.col("play_id") % 7) > 20).cast("int"))
    model = train(data, ["a", "b", "c"], "won", seed=9)
    nodes = forest_nodes(spark, model, new_folder(spark, "forest"))
    assert nodes.columns == [c.split()[0] for c in NODES.split(", ")] and nodes.select("tree").distinct().count() == 100
    odd = spark.createDataFrame([(1000, "g", None, 1.0, 1.0, 1), (1001, "g", float("nan"), 1.0, 1.0, 1), (1002, "g", 1e300, -1e300, 0.0, 1)], data.schema)
    asked = data.unionByName(odd)
    by_model = {r.play_id: (r.ml_win_probability_pct, r.estrategia) for r in predict(model, asked).collect()}
    by_table = {r.play_id: (r.ml_win_probability_pct, r.estrategia) for r in predict_by_table(nodes, asked, ["a", "b", "c"]).collect()}
    assert by_table.keys() == by_model.keys() == {*range(400), 1002}
    assert len({p for p, _ in by_model.values()}) > 50
    assert all(by_table[k][0] == pytest.approx(by_model[k][0], abs=0.011) for k in by_model)


def test_scorer_refuses_a_part_of_a_play(spark, plays):
    scorer = PlayScorer(spark, "nowhere")
    whole = plays.withColumn("history_parts", F.lit(1))
    assert scorer.build_features(whole).count() == 60
    with pytest.raises(ValueError):
        scorer.build_features(plays.withColumn("history_parts", F.when(F.col("play_id") == "p3", 2).otherwise(1)))


def test_scorer_trains_on_first_use(spark, plays):
    plays.createOrReplaceTempView("plays_to_score")
    scorer = PlayScorer(spark, "plays_to_score", seed=1)
    assert scorer.model is None
    assert scorer.predict(scorer.get_data()).count() == 60
    model = scorer.model
    assert model is not None
    split = plays.withColumn("history_part", F.lit(0))
    split = split.unionByName(split.withColumn("history_part", F.lit(1)))
    assert scorer.predict(split).count() == 60 and scorer.model is model


def test_scoring_a_single_play(spark, plays):
    features = array_features(plays.limit(1))
    assert predict(train(features, seed=2), features).count() == 1
