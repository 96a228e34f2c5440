"""A fitted forest as a table of nodes, and scores read off such a table without MLlib.

A model that is rows can be stored, compared and scored by plain expressions, also where the library that fitted it is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.numbers import score_band
from gridpulse.plans.scoring import FOREST_DEPTH, feature_names

NODES = "tree INT, node INT, feature INT, threshold DOUBLE, left INT, right INT, chance DOUBLE"


def forest_nodes(spark: SparkSession, model: PipelineModel, folder: str) -> DataFrame:
    """The nodes of the forest in ``model``, which is saved to ``folder`` for that: rows of ``NODES``.

    A row with features goes to ``left`` if its ``feature`` is at most ``threshold``, else to ``right``; a leaf has -1
    for both. ``chance`` is the share of class 1 among a node's training rows. Node 0 is a tree's root.
    """
    model.stages[-1].write().overwrite().save(folder)
    saved = spark.read.parquet(f"{folder}/data").select("treeID", F.col("nodeData").alias("n"))
    stats = F.col("n.impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    leaf = F.col("n.leftChild") < 0
    return saved.select(
        F.col("treeID").cast("int").alias("tree"),
        F.col("n.id").cast("int").alias("node"),
        F.when(~leaf, F.col("n.split.featureIndex")).cast("int").alias("feature"),
        F.when(~leaf, F.get("n.split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.col("n.leftChild").cast("int").alias("left"),
        F.col("n.rightChild").cast("int").alias("right"),
        F.try_divide(F.get(stats, F.lit(1)), total).alias("chance"),
    )


def table_chance(features: Sequence[str], trees: Column, depth: int = FOREST_DEPTH) -> Column:
    """Mean over ``trees`` (arrays of node structs) of the chance at the leaf that a row's ``features`` lead to."""
    values = F.array(*[F.col(c).cast("double") for c in features])

    def leaf(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            here = F.get(tree, at)
            further = F.when(F.get(values, here["feature"]) <= here["threshold"], here["left"]).otherwise(here["right"])
            return F.when(here["left"] < 0, at).otherwise(further)

        return F.get(tree, F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step))["chance"]

    return F.aggregate(F.transform(trees, leaf), F.lit(0.0), lambda a, x: a + x) / F.size(trees)


def predict_by_table(
    nodes: DataFrame,
    features: DataFrame,
    inputs: Sequence[str] | None = None,
    keys: Sequence[str] = ("game_id", "play_id"),
    depth: int = FOREST_DEPTH,
) -> DataFrame:
    """Chance of class 1 in percent, and its band, as ``scoring.predict`` gives them; rows with a NULL or NaN input are skipped.

    The node table, bounded by the model, is one value to every row (a scalar subquery); each row walks down each tree,
    at most ``depth`` steps, inside one expression. Trees' nodes are numbered from 0 without gaps.
    """
    inputs = list(inputs or feature_names())
    for c in inputs:
        features = features.where(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
    node = F.struct("node", "feature", "threshold", "left", "right", "chance")
    by_tree = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    trees = by_tree.agg(F.array_sort(F.collect_list(F.struct("tree", "nodes")))["nodes"].alias("all"))
    chance = F.round(table_chance(inputs, F.col("_trees"), depth) * 100, 2)
    scored = features.withColumn("_trees", trees.scalar()).withColumn("ml_win_probability_pct", chance)
    return scored.select(*keys, "ml_win_probability_pct", score_band("ml_win_probability_pct").alias("estrategia"))
