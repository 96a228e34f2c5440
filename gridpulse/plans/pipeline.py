"""One run of the whole flow: new events to bronze and silver, then gold from what is new or from all of silver."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.plans.gold import play_histories, play_trajectory, player_features, player_histories
from gridpulse.plans.incremental import IncrementalGold
from gridpulse.plans.rule_history import RuleHistory, write_checked
from gridpulse.plans.rules import TELEMETRY_RULES
from gridpulse.plans.silver import (
    KAFKA_COLUMNS,
    late_of_marked,
    marked_stream,
    silver_of_marked,
    silver_stream,
    unchecked_silver_batch,
)
from gridpulse.sources.tables import Layer, register_table, write_table
from gridpulse.streaming.runs import StreamRun, process_stream, write_stream


@dataclass(frozen=True)
class PipelineRun:
    """The tables of a run. ``silver_run`` is None when silver was recomputed as a batch, ``gold_run`` when gold was."""

    bronze: Layer
    silver: Layer
    player_features: Layer
    play_trajectory: Layer
    player_histories: Layer
    play_histories: Layer
    bronze_run: StreamRun
    silver_run: StreamRun | None
    gold_run: StreamRun | None = None
    late: Layer | None = None
    rules: RuleHistory | None = None


def run(
    spark: SparkSession,
    bronze_stream: DataFrame,
    out_dir: str,
    silver: str = "stream",
    full_refresh: bool = False,
    drop: Sequence[str] = KAFKA_COLUMNS,
    precision: str = "second",
    partition_by: Sequence[str] = ("game_id",),
    cluster_by: Sequence[str] = ("game_id",),
    spread_by: str | None = None,
    max_files_per_trigger: int | None = None,
    database: str | None = None,
    gold: str = "recompute",
    late: str = "drop",
) -> PipelineRun:
    """Processes what has arrived since the last run into ``out_dir``, then stops.

    ``silver="stream"`` appends to silver with a watermark, ``"batch"`` recomputes it; either is
    partitioned by ``partition_by``. ``gold="recompute"`` makes gold from all of silver, laid out by
    ``cluster_by``; ``"incremental"`` rewrites the games that new silver rows belong to (see
    ``plans.incremental``), which needs a streaming silver. A generation keeps to one of the two.
    ``late="keep"`` puts rows behind the watermark into a table of their own (``late``), by way of a table of
    marked rows; ``"drop"`` only counts them. Either is for a streaming silver, and a generation keeps to it.
    Rows that break silver's rules are counted by the write, in ``rules``, run by run; a batch silver keeps them
    beside the others. With ``database`` every table also gets a name there, a comment and its ``quality``.
    ``full_refresh`` starts over with new tables and checkpoints; the old ones stay where they are.
    """
    if silver not in ("stream", "batch"):
        raise ValueError(f"silver must be 'stream' or 'batch', not {silver!r}")
    if gold not in ("recompute", "incremental") or (gold, silver) == ("incremental", "batch"):
        raise ValueError("gold must be 'recompute', or 'incremental' with a streaming silver")
    if late not in ("drop", "keep") or (late, silver) == ("keep", "batch"):
        raise ValueError("late must be 'drop', or 'keep' with a streaming silver")
    base = f"{out_dir.rstrip('/')}/generation-{_generation(spark, out_dir, full_refresh)}"

    bronze_layer = Layer(spark, path=f"{base}/bronze", schema=bronze_stream.schema)
    bronze_run = write_stream(bronze_stream, bronze_layer.path, f"{base}/checkpoints/bronze")

    silver_path, late_layer, rules = f"{base}/silver", None, RuleHistory(spark, f"{base}/rule_history")
    if silver == "stream":
        arrived = bronze_layer.read_stream(max_files_per_trigger)
        if late == "keep":
            marked = _written(spark, marked_stream(arrived, precision), base, "marked", partition_by)
            late_layer = _written(spark, late_of_marked(marked.read_stream()), base, "late")
            cleaned = silver_of_marked(marked.read_stream(max_files_per_trigger), drop)
        else:
            cleaned = silver_stream(arrived, drop, precision, spread_by=spread_by)
        silver_run = write_stream(cleaned, silver_path, f"{base}/checkpoints/silver", partition_by=partition_by)
        if "rows" in silver_run.observed.get("silver_rules", {}):
            rules.add_observed(silver_run.observed["silver_rules"], TELEMETRY_RULES, "silver", rules.next_run())
        silver_layer = Layer(spark, path=silver_path, schema=cleaned.schema)
    else:
        bronze = bronze_layer.read()
        unchecked = unchecked_silver_batch(bronze, drop, precision, order_by=arrival_order(bronze))
        checked = write_checked(unchecked, TELEMETRY_RULES, silver_path, partition_by)
        rules.add(checked.counts, "silver", rules.next_run())
        silver_run, silver_layer = None, checked.kept

    if gold == "incremental":
        kept = IncrementalGold(spark, base)
        tables = kept.tables(silver_layer.schema)
        gold_run = process_stream(silver_layer.read_stream(max_files_per_trigger), kept.update, f"{base}/checkpoints/gold")
    else:
        tables, gold_run = _recomputed(spark, silver_layer, base, cluster_by), None
    if database:
        for name, layer in {"bronze": bronze_layer, "silver": silver_layer, **tables, **({"late": late_layer} if late_layer else {})}.items():
            quality = {"bronze": "bronze", "silver": "silver", "late": "silver"}.get(name, "gold")
            comment = f"{COMMENTS[name]}, generation {base.rsplit('-', 1)[1]}"
            register_table(spark, f"{database}.{name}", layer.path, comment, {"quality": quality})
    return PipelineRun(bronze_layer, silver_layer, bronze_run=bronze_run, silver_run=silver_run, gold_run=gold_run, late=late_layer, rules=rules, **tables)


def _written(spark: SparkSession, stream: DataFrame, base: str, name: str, partition_by: Sequence[str] = ()) -> Layer:
    """Appends what has arrived to table ``name`` of the generation."""
    layer = Layer(spark, path=f"{base}/{name}", schema=stream.schema)
    write_stream(stream, layer.path, f"{base}/checkpoints/{name}", partition_by=partition_by)
    return layer


def _recomputed(spark: SparkSession, silver: Layer, base: str, cluster_by: Sequence[str]) -> dict[str, Layer]:
    tables = {}

    def publish(name: str, table: DataFrame) -> DataFrame:
        write_table(table, path=f"{base}/{name}", cluster_by=cluster_by)
        tables[name] = Layer(spark, path=f"{base}/{name}", schema=table.schema)
        return tables[name].read()

    # Histories are written first, so that no array is built twice. Their files are a small part of their rows, so that
    # Spark would take them for tables to broadcast.
    players = publish("player_histories", player_histories(silver.read())).hint("merge")
    publish("player_features", player_features(silver.read(), parts=players))
    plays = publish("play_histories", play_histories(silver.read())).hint("merge")
    publish("play_trajectory", play_trajectory(silver.read(), parts=plays))
    return tables


COMMENTS = {
    "bronze": "Events as they came in",
    "silver": "Typed, deduplicated, checked events",
    "player_features": "Features of every player and game",
    "play_trajectory": "Samples of every play in time order",
    "player_histories": "Accelerations of every player and game, in parts",
    "play_histories": "Samples of every play, in parts",
    "late": "Events that came after the watermark had passed them",
}


def arrival_order(bronze: DataFrame) -> list[str] | None:
    """The columns that say which copy came in first, as far as the bronze table has them."""
    return [c for c in ("kafka_timestamp", "partition", "offset") if c in bronze.columns] or None


def batch_silver_metrics(bronze: DataFrame) -> DataFrame:
    """Rule counts of a batch silver; a streaming silver reports them in its run."""
    return TELEMETRY_RULES.metrics(unchecked_silver_batch(bronze, order_by=arrival_order(bronze)))


def _generation(spark: SparkSession, out_dir: str, full_refresh: bool) -> int:
    """Number of the current set of tables, kept in a one-row table next to them."""
    log = f"{out_dir.rstrip('/')}/generations"
    try:
        latest = spark.read.schema("generation INT").parquet(log).agg(F.max("generation")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        latest = None
    if latest is not None and not full_refresh:
        return latest
    generation = 0 if latest is None else latest + 1
    spark.range(1).select(F.lit(generation).alias("generation")).write.mode("append").parquet(log)
    return generation
