"""Array features of a play, a random forest on them, and its scores as bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.arrays import array_mean
from gridpulse.functions.numbers import score_band
from gridpulse.session import cut_lineage

# Feature suffix -> array inside the play trajectory.
TRAJECTORY_FIELDS = {
    "vel": "telemetry_history_array.speed_mph",
    "acc": "telemetry_history_array.acceleration_m_s2",
}
FOREST_TREES = 100  # fixed value
FOREST_DEPTH = 5  # fixed value


def feature_names(fields: Sequence[str] = tuple(TRAJECTORY_FIELDS)) -> list[str]:
    return [f"{statistic}_{name}" for name in fields for statistic in ("mean", "max", "min")]


def array_features(df: DataFrame, fields: dict[str, str] = TRAJECTORY_FIELDS) -> DataFrame:
    """Mean, largest and smallest value of every array in ``fields``, without exploding it.

    Arrays without values give 0.0, and so does the mean of an array with a NULL in it.
    """
    columns = {}
    for name, source in fields.items():
        values = F.col(source)
        columns[f"mean_{name}"] = array_mean(values)
        columns[f"max_{name}"] = F.array_max(values).cast("double")
        columns[f"min_{name}"] = F.array_min(values).cast("double")
    return df.withColumns(columns).fillna(0.0, subset=list(columns))


def play_features(
    trajectory: DataFrame,
    keys: Sequence[str] = ("game_id", "play_id"),
    fields: dict[str, str] = TRAJECTORY_FIELDS,
) -> DataFrame:
    """``array_features`` of whole plays from ``play_histories``, whose parts may be several for a play.

    Every part is reduced where it lies to a sum, a size, a maximum and a minimum; those are combined.
    """
    parts, totals, result = [], [], []
    for name, source in fields.items():
        values = F.col(source)
        parts += [
            F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x.cast("double")).alias(f"_s_{name}"),
            F.size(values).alias(f"_n_{name}"),
            F.array_max(values).cast("double").alias(f"_hi_{name}"),
            F.array_min(values).cast("double").alias(f"_lo_{name}"),
        ]
        totals += [
            # One part without a sum leaves the whole play without a mean.
            F.when(F.count(f"_s_{name}") == F.count(F.lit(1)), F.sum(f"_s_{name}")).alias(f"_s_{name}"),
            F.sum(f"_n_{name}").alias(f"_n_{name}"),
            F.max(f"_hi_{name}").alias(f"max_{name}"),
            F.min(f"_lo_{name}").alias(f"min_{name}"),
        ]
        result += [
            F.try_divide(F.col(f"_s_{name}"), F.col(f"_n_{name}")).alias(f"mean_{name}"),
            F.col(f"max_{name}"),
            F.col(f"min_{name}"),
        ]
    combined = trajectory.select(*keys, *parts).groupBy(*keys).agg(*totals).select(*keys, *result)
    return combined.fillna(0.0, subset=feature_names(tuple(fields)))


def random_labels(df: DataFrame, seed: int = 0) -> DataFrame:
    """Labels 0 and 1 by chance, where none are known."""
    return df.withColumn("label", F.when(F.rand(seed) > 0.5, 1).otherwise(0))


def balance_single_row(df: DataFrame) -> DataFrame:
    """A one-row training table becomes two rows, labelled 0 and 1; any other stays as it is."""
    if df.limit(2).count() != 1:
        return df
    return df.withColumn("label", F.lit(0)).unionByName(df.withColumn("label", F.lit(1)))


def train(
    features: DataFrame, inputs: Sequence[str] | None = None, label: str | None = None, seed: int = 0
) -> PipelineModel:
    """Random forest on ``inputs``; rows with invalid values are skipped. No ``label``: random ones.

    The fit passes over its input several times, so the few columns it needs are written once.
    """
    inputs = list(inputs or feature_names())
    labelled = random_labels(features, seed) if label is None else features.withColumn("label", F.col(label))
    labelled = cut_lineage(labelled.select(*inputs, "label"))
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="skip")
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=FOREST_TREES, maxDepth=FOREST_DEPTH, seed=seed
    )
    return Pipeline(stages=[assembler, forest]).fit(balance_single_row(labelled))


def predict(model: PipelineModel, features: DataFrame, keys: Sequence[str] = ("game_id", "play_id")) -> DataFrame:
    """Chance of class 1 in percent, and its band."""
    chance = F.round(vector_to_array("probability")[1] * 100, 2)
    scored = model.transform(features).withColumn("ml_win_probability_pct", chance)
    return scored.select(*keys, "ml_win_probability_pct", score_band("ml_win_probability_pct").alias("estrategia"))


class PlayScorer:
    """Scores the plays of a trajectory table, training on first use."""

    def __init__(self, spark: SparkSession, feature_table: str, seed: int = 0):
        self.spark = spark
        self.feature_table = feature_table
        self.seed = seed
        self.model: PipelineModel | None = None

    def get_data(self) -> DataFrame:
        return self.spark.read.table(self.feature_table)

    def build_features(self, df: DataFrame) -> DataFrame:
        """Features of whole plays. A trajectory with further parts is refused: its array is not the whole play."""
        if "history_part" in df.columns:
            return play_features(df)
        if "history_parts" in df.columns and not df.where("history_parts > 1").isEmpty():
            raise ValueError("plays of several parts: give their histories (play_histories) instead")
        return array_features(df)

    def train(self, features: DataFrame, label: str | None = None) -> PipelineModel:
        self.model = train(features, label=label, seed=self.seed)
        return self.model

    def predict(self, df: DataFrame) -> DataFrame:
        features = self.build_features(df)
        return predict(self.model or self.train(features), features)
