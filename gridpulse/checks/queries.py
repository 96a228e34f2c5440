"""Every operator on the supplied tables. Each query reads its tables whole.

``events`` stands in for telemetry: a user is a player, an event type a position, a day a game and an
hour a play; ``value`` and the JSON field ``k`` are the measurements.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridpulse import schemas
from gridpulse.checks import forest
from gridpulse.functions import event_time, score_band, surrogate_key
from gridpulse.operators import (
    Expectations,
    Rule,
    dedup_batch,
    first_per_group,
    nearest_per_group,
    star_join,
    zorder_layout,
)
from gridpulse.operators.star import Dimension
from gridpulse.plans.bronze import bronze_from_files, bronze_from_records
from gridpulse.plans.dimensions import GAME, PLAY, PLAYER
from gridpulse.plans.forest_table import NODES, predict_by_table
from gridpulse.plans.gold import play_histories, play_trajectory, player_features
from gridpulse.plans.maintenance import optimize
from gridpulse.plans.pipeline import PipelineRun, run
from gridpulse.plans.reports import matchup_report
from gridpulse.plans.rule_history import RuleHistory, write_checked
from gridpulse.plans.rules import TELEMETRY_RULES
from gridpulse.plans.scoring import PlayScorer, array_features, balance_single_row, play_features, predict, random_labels, train
from gridpulse.plans.separation import separation_fact
from gridpulse.plans.silver import clean_metrics, silver_batch, silver_stream, unchecked_silver_batch
from gridpulse.session import new_folder
from gridpulse.sources import (
    Layer,
    analyze_table,
    decode_events,
    encode_events,
    read_dimension_csv,
    with_rescued_data,
    write_table,
)
from gridpulse.sources.schema_log import EvolvingTable
from gridpulse.sources.zone_map import ZoneMap
from gridpulse.streaming import dedup_stream, write_stream
from gridpulse.streaming.late import ROCKS, STORE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__.removesuffix("_query")] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- events in the shapes the jobs expect --------------------------------------------------------


def event_k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def epoch_ms() -> F.Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the telemetry columns. Speeds are cut to quarters, so their sums are exact.

    ``event_id`` comes along as the order of arrival.
    """
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.to_date("ts").cast("string").alias("game_id"),
        F.lpad(F.hour("ts").cast("string"), 2, "0").alias("play_id"),
        F.lit("ACTIVO").alias("play_status"),
        F.col("user_id").cast("string").alias("player_id"),
        F.concat(F.lit("user "), F.col("user_id")).alias("player_name"),
        F.col("event_type").alias("position"),
        F.lit("T").alias("team"),
        F.col("value").alias("x_coord"),
        event_k().cast("double").alias("y_coord"),
        (F.floor(F.col("value") * 4) / 4).alias("speed_mph"),
        F.col("value").alias("acceleration_m_s2"),
        event_k().alias("heart_rate_bpm"),
        F.lit(50.0).alias("stamina_pct"),
        epoch_ms().alias("timestamp"),
    )


def by_second() -> dict[str, F.Column]:
    """Measurements that depend on player and second alone; the speed rule drops every seventh row or so."""
    player, second = F.col("player_id").cast("bigint"), F.floor(F.col("timestamp") / 1000)
    return {
        "speed_mph": F.pmod(player * 31 + second, F.lit(140)).cast("double") / 4,
        "heart_rate_bpm": F.when(F.pmod(player * 7 + second, F.lit(11)) > 0, F.pmod(player * 5 + second, F.lit(100)) + 60).cast("int"),
        "acceleration_m_s2": F.pmod(player * 13 + second, F.lit(50)).cast("double") / 4,
    }


def records(spark: SparkSession, sf_dir: str, same_by_second: bool = False) -> DataFrame:
    """The same events as Kafka records: keyed JSON with topic, partition, offset and time.

    A streaming dedup may keep either of two samples of one second. With ``same_by_second`` both have the
    same measurements, so that all of the result is certain.
    """
    events = telemetry(spark, sf_dir)
    if same_by_second:
        events = events.withColumns(by_second())
    arrived = events.select(
        *[c for c in events.columns if c != "event_id"],
        F.lit("tracking").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_millis("timestamp").alias("arrival"),
    )
    encoded = encode_events(arrived, record_columns=("topic", "partition", "offset", "arrival"))
    return encoded.withColumnRenamed("arrival", "timestamp")


def stream_of(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back as a stream."""
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.readStream.schema(df.schema).parquet(folder)


def written_stream(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Runs the stream over what is there and returns the table it wrote."""
    folder = new_folder(spark, label)
    write_stream(df, folder, new_folder(spark, f"{label}-checkpoint"))
    return spark.read.schema(df.schema).parquet(folder)


def seconds(name: str = "timestamp") -> F.Column:
    return F.unix_seconds(F.col(name))


# --- sources and decoding ------------------------------------------------------------------------


@query
def event_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit("props").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    decoded = decode_events(raw, StructType.fromDDL("k INT"))
    return decoded.select("offset", "topic", "partition", F.unix_millis("kafka_timestamp").alias("kafka_ms"), "k")


@query
def rescued_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k`` is unknown to the schema, and ``value`` does not fit it in every row."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.to_json(F.struct("event_type", event_k().alias("k"), F.col("event_type").alias("value"))).alias("value"),
    )
    return with_rescued_data(events, StructType.fromDDL("event_type STRING, value DOUBLE")).select(
        "event_id", "event_type", F.col("value").alias("typed_value"), F.col("_rescued_data").alias("rescued")
    )


@query
def encode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_events(records(spark, sf_dir), schemas.TELEMETRY)
    return decoded.select(
        "game_id", "play_id", "player_id", "position", "speed_mph", "acceleration_m_s2", "heart_rate_bpm",
        F.col("timestamp").alias("epoch_ms"),
    )


@query
def file_stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files through the file stream, with rescue column, source file and arrival time."""
    folder = new_folder(spark, "landing")
    telemetry(spark, sf_dir).drop("event_id").select(F.to_json(F.struct("*")).alias("value")).write.text(folder)
    known = StructType([f for f in schemas.TELEMETRY.fields if f.name not in ("stamina_pct", "team")])
    landed = written_stream(spark, bronze_from_files(spark, folder, known), "bronze")
    return landed.select(
        "game_id", "play_id", "player_id", "speed_mph", "heart_rate_bpm",
        F.col("timestamp").alias("epoch_ms"),
        F.col("_rescued_data").alias("rescued"),
        F.endswith(F.col("source_file"), F.lit(".txt")).alias("has_source"),
        F.isnotnull("ingested_at").alias("has_arrival"),
    )


@query
def record_stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped records through the bronze stream."""
    stream = stream_of(spark, records(spark, sf_dir), "records")
    landed = written_stream(spark, bronze_from_records(stream), "bronze")
    return landed.select(
        "game_id", "play_id", "player_id", "position", "x_coord", "y_coord", "topic",
        F.col("timestamp").alias("epoch_ms"),
        F.unix_millis("kafka_timestamp").alias("kafka_ms"),
        F.isnotnull("ingested_at").alias("has_arrival"),
    )


@query
def dimension_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "csv")
    table(spark, sf_dir, "customer").write.option("header", True).csv(folder)
    text = StructType.fromDDL("c_custkey STRING, c_name STRING, c_nationkey STRING, c_acctbal STRING, c_mktsegment STRING")
    return read_dimension_csv(spark, folder, text).select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment", F.col("c_acctbal").try_cast("double").alias("c_acctbal")
    )


@query
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three generations of files: ``k`` comes with the second, whose ``score`` is no whole number, ``note`` with the third."""
    landing, base = new_folder(spark, "landing"), new_folder(spark, "evolving")
    events, key = table(spark, sf_dir, "events"), F.col("event_id")
    generations = [
        {"score": F.floor("value")},
        {"score": F.col("value"), "k": event_k()},
        {"score": F.col("value"), "k": event_k(), "note": F.concat(F.lit("user "), F.col("user_id"))},
    ]
    evolving = EvolvingTable(spark, landing, base)
    for i, fields in enumerate(generations):
        rows = events.where(key % 3 == i).select("event_id", "event_type", *[c.alias(n) for n, c in fields.items()])
        rows.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(landing)
        evolving.run()
    versions = len(evolving.log.versions())
    return evolving.read().select(
        "event_id", "event_type", "score", "k", "note", F.col("_rescued_data").alias("rescued"), F.lit(versions).alias("versions")
    )


# --- scalar operators ----------------------------------------------------------------------------


@query
def event_time_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", epoch_ms().alias("ms"))
    return events.select(
        "event_id",
        F.unix_seconds(event_time("ms")).alias("epoch_s"),
        F.unix_millis(event_time("ms", "millis")).alias("epoch_ms"),
    )


@query
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        surrogate_key("o_orderkey").alias("order_sk"),
        surrogate_key("o_custkey", "o_orderstatus").alias("pair_sk"),
    )


@query
def score_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", score_band("value").alias("band"))


@query
def array_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return array_features(vectors, {"vec": "embedding"}).select("vec_id", "mean_vec", "max_vec", "min_vec")


# --- quality and duplicates ----------------------------------------------------------------------

EVENT_RULES = Expectations(
    (
        Rule("value_valid", "value >= 0.0 AND value <= 30.0", drop=True),
        Rule("props_present", "props IS NOT NULL", drop=True),
        Rule("value_high", "value BETWEEN 20 AND 120"),
    )
)


@query
def quality_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EVENT_RULES.keep(table(spark, sf_dir, "events")).select("event_id", "value")


@query
def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EVENT_RULES.metrics(table(spark, sf_dir, "events"))


@query
def quality_metrics_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EVENT_RULES.metrics(table(spark, sf_dir, "events"), by=["event_type"])


@query
def dedup_batch_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "value")
    return dedup_batch(events.unionAll(events), ["user_id", "event_type", "ts"]).select("user_id", "event_type", "ts")


@query
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return dedup_batch(events, ["user_id", "event_type"], order_by=["ts", "event_id"]).select(
        "user_id", "event_type", "event_id", "value"
    )


@query
def first_in_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank 1 by price within every part, ties by order and line."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_extendedprice", "l_orderkey", "l_linenumber", "l_quantity")
    return first_per_group(lines, ["l_partkey"], ["l_extendedprice", "l_orderkey", "l_linenumber", "l_quantity"])


@query
def dedup_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # The star also lets a single file stand for a folder of files.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    days = events.select("event_type", "user_id", "event_id", F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day"))
    single = dedup_stream(days, ["event_type", "user_id", "day"], "day", spread_by="event_id")
    return written_stream(spark, single, "dedup").select("event_type", "user_id", seconds("day").alias("day_s"))


# --- silver and gold -----------------------------------------------------------------------------


@query
def silver_from_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_from_records(records(spark, sf_dir))
    silver = silver_batch(bronze.unionByName(bronze), order_by=("kafka_timestamp", "partition", "offset"))
    return silver.select("game_id", "play_id", "player_id", "speed_mph", "heart_rate_bpm", seconds().alias("epoch_s"))


@query
def silver_rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_from_records(records(spark, sf_dir))
    return TELEMETRY_RULES.metrics(unchecked_silver_batch(bronze, order_by=("kafka_timestamp", "partition", "offset")))


@query
def rule_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule results of two runs of a batch silver, the second with the other half of the events, and its rows by folder."""
    events, out = records(spark, sf_dir), new_folder(spark, "checked")
    history = RuleHistory(spark, f"{out}/history")
    for arrived in (events.where("offset % 2 = 0"), events):
        unchecked = unchecked_silver_batch(bronze_from_records(arrived), order_by=("kafka_timestamp", "partition", "offset"))
        run_number = history.next_run()
        checked = write_checked(unchecked, TELEMETRY_RULES, f"{out}/silver-{run_number}", ["game_id"])
        history.add(checked.counts, "silver", run_number)
    kept, dropped = checked.kept.read().count(), checked.dropped.read().count()
    return history.read().select(
        "run", "rule", "action", "passed", "failed", F.lit(kept).alias("kept"), F.lit(dropped).alias("dropped")
    )


@query
def silver_from_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the streaming silver keeps, its rules included; two samples of a second have equal measurements."""
    bronze = stream_of(spark, bronze_from_records(records(spark, sf_dir, same_by_second=True)), "bronze")
    silver = written_stream(spark, silver_stream(bronze), "silver")
    return silver.select(
        "game_id", "play_id", "player_id", "speed_mph", "heart_rate_bpm", "acceleration_m_s2", seconds().alias("epoch_s"),
        F.isnotnull("silver_processed_at").alias("has_stamp"),
    )


@query
def silver_from_junk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event thrice: as it is, with its time in nanoseconds, and as broken JSON; none stops the stream.

    Rows without a usable time stay, copies included; a broken record has no heart rate and is dropped.
    """
    good = records(spark, sf_dir, same_by_second=True)
    text = F.col("value").cast("string")
    huge = good.withColumn("value", F.regexp_replace(text, r'"timestamp":(\d+)', '"timestamp":$1000000').cast("binary"))
    broken = good.withColumn("value", F.substring(text, 2, 1000).cast("binary"))
    bronze = stream_of(spark, bronze_from_records(good.unionByName(huge).unionByName(broken)), "bronze")
    silver = written_stream(spark, silver_stream(bronze), "silver")
    return silver.groupBy("game_id", "play_id").agg(
        F.count_if(F.col("timestamp").isNotNull()).alias("timed"), F.count_if(F.col("timestamp").isNull()).alias("untimed")
    )


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, checked events; they hold no copies to remove."""
    return TELEMETRY_RULES.keep(clean_metrics(telemetry(spark, sf_dir)))


@query
def player_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return player_features(silver_events(spark, sf_dir), stamp=False)


@query
def play_trajectory_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays = play_trajectory(silver_events(spark, sf_dir), stamp=False)
    return plays.select(
        "game_id", "play_id", "max_speed_in_play", "players_tracked", "history_parts",
        F.array_join("telemetry_history_array.player_id", ",").alias("players_in_order"),
        F.col("telemetry_history_array.acceleration_m_s2").alias("accelerations"),
        F.col("telemetry_history_array.speed_mph").alias("speeds"),
        F.transform("telemetry_history_array.timestamp", lambda t: F.unix_seconds(t)).alias("times_s"),
        F.size("telemetry_history_array").cast("bigint").alias("samples"),
    )


@query
def medallion_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records → bronze → streaming silver → gold, through the incremental run: the plays."""
    stream = stream_of(spark, records(spark, sf_dir, same_by_second=True), "records")
    result = run(spark, bronze_from_records(stream), new_folder(spark, "medallion"))
    return result.play_trajectory.read().select(
        "game_id", "play_id", "players_tracked", "max_speed_in_play",
        F.size("telemetry_history_array").cast("bigint").alias("samples"),
        F.isnotnull("feature_timestamp").alias("has_stamp"),
    )


@query
def medallion_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The players' features after a second run that finds nothing new and a full refresh."""
    folder = new_folder(spark, "records")
    arrived = records(spark, sf_dir, same_by_second=True)
    arrived.write.parquet(folder)
    out = new_folder(spark, "medallion")
    for full_refresh in (False, False, True):
        stream = spark.readStream.schema(arrived.schema).parquet(folder)
        result = run(spark, bronze_from_records(stream), out, full_refresh=full_refresh)
    return result.player_features.read().drop("feature_timestamp")


def two_arrivals(spark: SparkSession, sf_dir: str, **options) -> PipelineRun:
    """The pipeline over the earlier seven tenths of the events, then over the rest; one day is in both."""
    events = records(spark, sf_dir, same_by_second=True)
    middle = telemetry(spark, sf_dir).agg((F.min("timestamp") * 0.3 + F.max("timestamp") * 0.7).cast("bigint")).first()[0]
    folder, out = new_folder(spark, "records"), new_folder(spark, "medallion")
    for arrived in (F.unix_millis("timestamp") < middle, F.unix_millis("timestamp") >= middle):
        events.where(arrived).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(events.schema).parquet(folder)
        result = run(spark, bronze_from_records(stream), out, **options)
    return result


@query
def medallion_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays after two arrivals, each of which rewrote the games it had rows of."""
    plays = two_arrivals(spark, sf_dir, gold="incremental").play_trajectory.read()
    return plays.select(
        "game_id", "play_id", "players_tracked", "max_speed_in_play", "history_parts",
        F.transform("telemetry_history_array.timestamp", lambda t: F.unix_seconds(t)).alias("times_s"),
        F.array_join("telemetry_history_array.player_id", ",").alias("players_in_order"),
        F.isnotnull("feature_timestamp").alias("has_stamp"),
    )


@query
def medallion_incremental_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players' features after two arrivals, as a full refresh gives them."""
    return two_arrivals(spark, sf_dir, gold="incremental").player_features.read().drop("feature_timestamp")


@query
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and the late table after two arrivals, with a restart between them: every tenth event comes too late."""
    events = records(spark, sf_dir, same_by_second=True)
    middle = telemetry(spark, sf_dir).agg((F.min("timestamp") * 0.3 + F.max("timestamp") * 0.7).cast("bigint")).first()[0]
    first = (F.unix_millis("timestamp") < middle) & (F.col("offset") % 10 != 0)
    folder, out = new_folder(spark, "records"), new_folder(spark, "medallion")
    spark.conf.set(STORE, ROCKS)
    for arrived in (first, ~first):
        events.where(arrived).write.mode("append").parquet(folder)
        stream = bronze_from_records(spark.readStream.schema(events.schema).parquet(folder))
        result = run(spark, stream, out, late="keep")
    columns = ["game_id", "play_id", "player_id", "speed_mph", "heart_rate_bpm", seconds().alias("epoch_s")]
    kept = result.silver.read().select(*columns, F.lit(False).alias("is_late"))
    return kept.unionByName(result.late.read().select(*columns, F.lit(True).alias("is_late")))


# --- star schema, separation and report ----------------------------------------------------------


@query
def game_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as games: text in, typed and keyed rows out."""
    text = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("game_id"),
        F.year("o_orderdate").cast("string").alias("season"),
        F.month("o_orderdate").cast("string").alias("week"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("home_team"),
        F.col("o_orderpriority").alias("away_team"),
        F.lit("s").alias("stadium"),
        F.lit("t").alias("turf_type"),
        F.lit("w").alias("weather_conditions"),
        F.col("o_orderpriority").alias("temperature_f"),
    )
    return GAME.gold(GAME.silver(text))


@query
def game_rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of a game breaks for some order, and holds for others."""
    key, year = F.col("o_orderkey"), F.year("o_orderdate")
    text = table(spark, sf_dir, "orders").select(
        F.when(key % 13 > 0, key.cast("string")).otherwise("").alias("game_id"),
        F.when(key % 5 > 0, year).otherwise(year - 100).cast("string").alias("season"),
        F.lit("1").alias("week"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("home_team"),
        F.col("o_orderpriority").alias("away_team"),
        F.lit("s").alias("stadium"),
        F.lit("t").alias("turf_type"),
        F.lit("w").alias("weather_conditions"),
        (key % 200 - 40).cast("string").alias("temperature_f"),
    )
    return GAME.expectations.metrics(GAME.unchecked(text))


@query
def play_rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    text = table(spark, sf_dir, "lineitem").select(
        F.when(line != 7, line.cast("string")).alias("play_id"),
        F.col("l_orderkey").cast("string").alias("game_id"),
        (line + 1).cast("string").alias("quarter"),
        line.cast("string").alias("down"),
        (F.col("l_quantity").cast("int") - 10).cast("string").alias("distance_to_first"),
        F.col("l_returnflag").alias("expected_coverage"),
        F.col("l_linestatus").alias("play_result"),
    )
    return PLAY.expectations.metrics(PLAY.unchecked(text))


@query
def play_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("string").alias("play_id"),
        F.col("l_orderkey").cast("string").alias("game_id"),
        F.col("l_linestatus").alias("quarter"),
        F.col("l_linenumber").cast("string").alias("down"),
        F.col("l_quantity").cast("int").cast("string").alias("distance_to_first"),
        F.col("l_returnflag").alias("expected_coverage"),
        F.col("l_linestatus").alias("play_result"),
    )
    return PLAY.gold(PLAY.silver(text))


@query
def player_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("player_sk"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("full_name"),
        F.col("c_mktsegment").alias("team"),
        F.lit("WR").alias("position"),
        F.col("c_nationkey").cast("string").alias("height_in"),
        F.col("c_name").alias("weight_lbs"),
        F.lit("c").alias("college"),
        F.lit("2020").alias("draft_year"),
    )
    return PLAYER.gold(PLAYER.silver(text))


@query
def dimension_rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("player_sk"),
        F.when(F.col("p_size") > 5, F.col("p_name")).alias("full_name"),
        F.col("p_brand").alias("team"),
        F.col("p_type").alias("position"),
        (F.col("p_size") + 50).cast("string").alias("height_in"),
        (F.col("p_size") * 10).cast("string").alias("weight_lbs"),
        F.lit("c").alias("college"),
        F.lit("2020").alias("draft_year"),
    )
    return PLAYER.expectations.metrics(PLAYER.unchecked(text))


@query
def nearest_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every click the nearest view of the same hour, in the plane of value and k."""
    events = table(spark, sf_dir, "events").select(
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"),
        "event_id", "event_type", "value", event_k().cast("double").alias("k"),
    )
    closest = nearest_per_group(
        events.where(F.col("event_type") == "click"),
        events.where(F.col("event_type") == "view"),
        on=["hour"], left_keys=["hour", "event_id"], right_id="event_id",
        x="value", y="k", right_name="nearest_event_id",
    )
    return closest.select(seconds("hour").alias("hour_s"), "event_id", "nearest_event_id", "separation")


def event_fact(spark: SparkSession, sf_dir: str, match_on: tuple[str, ...]) -> DataFrame:
    """Clicks are receivers, views defenders, and an instant is an hour of a day."""
    events = telemetry(spark, sf_dir).withColumn("timestamp", F.date_trunc("hour", event_time("timestamp")))
    fact = separation_fact(events, offense="click", defense="view", match_on=match_on)
    return fact.withColumn("timestamp", seconds())


@query
def separation_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_fact(spark, sf_dir, ("play_id", "timestamp"))


@query
def separation_facts_by_game(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_fact(spark, sf_dir, ("game_id", "play_id"))


@query
def separation_one_game(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of one game, the first."""
    events = telemetry(spark, sf_dir).withColumn("timestamp", F.date_trunc("hour", event_time("timestamp")))
    first = events.agg(F.min("game_id")).first()[0]
    return separation_fact(events, game_id=first, offense="click", defense="view").withColumn("timestamp", seconds())


@query
def matchup_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations of customers against nations of suppliers, over orders of the third priority."""
    orders, nation = table(spark, sf_dir, "orders"), table(spark, sf_dir, "nation")
    fact = star_join(
        table(spark, sf_dir, "lineitem").select(
            "l_suppkey", F.col("l_orderkey").alias("play_sk"), F.col("l_quantity").alias("separation_yards")
        ),
        [
            Dimension(orders, "o_orderkey", "play_sk", {"o_custkey": "o_custkey"}),
            Dimension(table(spark, sf_dir, "customer"), "c_custkey", "o_custkey", {"offensive_player_sk": "c_nationkey"}),
            Dimension(table(spark, sf_dir, "supplier"), "s_suppkey", "l_suppkey", {"defensive_player_sk": "s_nationkey"}),
        ],
    )
    players = nation.select(
        F.col("n_nationkey").alias("player_sk"), F.col("n_name").alias("full_name"), F.col("n_regionkey").alias("team")
    )
    plays = orders.select(
        F.col("o_orderkey").alias("play_sk"), F.substring("o_orderpriority", 1, 1).try_cast("int").alias("down")
    )
    return matchup_report(fact, players, plays)


# --- scoring -------------------------------------------------------------------------------------


@query
def play_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array features of the trajectories. Accelerations are cut to quarters here, so that their mean is exact."""
    silver = silver_events(spark, sf_dir).withColumn("acceleration_m_s2", F.floor(F.col("acceleration_m_s2") * 4) / 4)
    features = play_features(play_histories(silver))
    return features.select("game_id", "play_id", "mean_vel", "max_vel", "min_vel", "mean_acc", "max_acc", "min_acc")


@query
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same features as the scorer makes them from the catalog's feature table."""
    folder = new_folder(spark, "catalog")
    name = "features_" + folder.rsplit("-", 1)[1]
    silver = silver_events(spark, sf_dir).withColumn("acceleration_m_s2", F.floor(F.col("acceleration_m_s2") * 4) / 4)
    write_table(play_trajectory(silver, stamp=False), name=name, path=folder, comment="plays", properties={"quality": "gold"})
    scorer = PlayScorer(spark, name)
    features = scorer.build_features(scorer.get_data())
    features = features.select("game_id", "play_id", "mean_vel", "max_vel", "min_vel", "mean_acc", "max_acc", "min_acc")
    kept = Layer(spark, path=stored_rows(spark, features), schema=features.schema)
    spark.sql(f"DROP TABLE {name}")
    return kept.read()


@query
def random_label_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is certain of labels by chance: every row has one, about half of them 1, and the seed decides which."""
    events = table(spark, sf_dir, "events").select("event_id")
    labelled = random_labels(events, seed=5)
    again = random_labels(events, seed=5)
    shares = labelled.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("label").isin(0, 1)).alias("n_labelled"),
        (F.abs(F.avg("label") - 0.5) < 0.1).alias("near_half"),
    )
    return shares.withColumn("same_again", F.lit(labelled.exceptAll(again).isEmpty()))


@query
def single_row_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one training row."""
    whole = table(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("max_value"))
    return balance_single_row(whole).select("n", "max_value", "label")


@query
def forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest whose inputs tell the label apart exactly, so every tree is pure and every chance is 0 or 100."""
    high = F.array_max("embedding") >= F.lit(0.3125)
    signs = F.when(high, F.array(*map(F.lit, (1.0, 2.0, 3.0)))).otherwise(F.array(*map(F.lit, (-1.0, -2.0, -6.0))))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", signs.alias("signs"), high.cast("int").alias("label"))
    features = array_features(vectors, {"vec": "signs"})
    model = train(features, inputs=["mean_vec", "max_vec", "min_vec"], label="label", seed=7)
    return predict(model, features, keys=["vec_id"])


@query
def forest_table_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a forest that is a table of nodes, on real features; its chances are eighths, so their sums are exact."""
    nodes = spark.createDataFrame(forest.NODES, NODES)
    features = array_features(table(spark, sf_dir, "embeddings"), {"vec": "embedding"})
    return predict_by_table(nodes, features, ["max_vec", "min_vec"], ["vec_id"], forest.DEPTH)


# --- layout and statistics -----------------------------------------------------------------------


def rewritten(spark: SparkSession, df: DataFrame, **layout) -> DataFrame:
    folder = new_folder(spark, "layout")
    write_table(df, path=folder, **layout)
    return Layer(spark, path=folder, schema=df.schema).read().select(*df.columns)


@query
def layout_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rewritten(spark, table(spark, sf_dir, "lineitem"), partition_by=["l_returnflag"])


@query
def layout_rewrite_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rewritten(spark, table(spark, sf_dir, "lineitem"), cluster_by=["l_partkey"])


@query
def layout_zorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rewritten(spark, zorder_layout(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_shipdate", "l_returnflag"]))


@query
def zone_map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of some parts and orders, from the files that the zone map of a Z-ordered rewrite names."""
    lines, folder = table(spark, sf_dir, "lineitem"), new_folder(spark, "zones")
    write_table(zorder_layout(lines, ["l_partkey", "l_orderkey"], 24), path=folder)
    layer = Layer(spark, path=folder, schema=lines.schema)
    zones = ZoneMap.build(layer, f"{folder}-map", ranges=["l_partkey", "l_shipdate"], members=["l_orderkey", "l_returnflag"])
    most = lines.agg(F.max("l_orderkey")).first()[0]
    found = zones.read(between={"l_partkey": (100, 400)}).unionByName(zones.read(equals={"l_orderkey": [1, most // 2, most]}))
    return found.unionByName(zones.read(equals={"l_returnflag": ["no such flag"]}))


def described_table(spark: SparkSession, name: str) -> DataFrame:
    """The catalog's description, which outlives the table; the name goes, so that no call leaves one behind."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    kept = spark.createDataFrame(described.collect(), described.schema)
    spark.sql(f"DROP TABLE {name}")
    return kept


def stored_rows(spark: SparkSession, df: DataFrame) -> str:
    folder = new_folder(spark, "rows")
    df.write.parquet(folder)
    return folder


@query
def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of lineitem as the catalog knows it after the analysis."""
    folder = new_folder(spark, "catalog")
    name = "stats_" + folder.rsplit("-", 1)[1]
    lines = table(spark, sf_dir, "lineitem")
    write_table(lines, name=name, path=folder, comment="order lines", properties={"quality": "gold"})
    analyze_table(spark, name)
    described = described_table(spark, name)

    def found(row: str, pattern: str) -> F.Column:
        return F.max(F.when(F.col("col_name") == row, F.regexp_extract("data_type", pattern, 1)))

    return described.agg(
        found("Statistics", r"(\d+) rows").cast("bigint").alias("n_rows"),
        found("Table Properties", r"quality=(\w+)").alias("quality"),
        found("Comment", r"(.+)").alias("comment"),
    )


@query
def table_optimized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a partitioned table still is after it was optimized under its own name, and its rows by partition."""
    folder = new_folder(spark, "catalog")
    name = "optimized_" + folder.rsplit("-", 1)[1]
    lines = table(spark, sf_dir, "lineitem")
    write_table(lines, name=name, path=folder, comment="order lines", properties={"quality": "gold"}, partition_by=["l_returnflag"])
    optimize(Layer(spark, name=name), ["l_partkey", "l_suppkey"], path=new_folder(spark, "optimized"))
    rows = spark.table(name).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_orderkey").alias("keys"))
    rows = Layer(spark, path=stored_rows(spark, rows), schema=rows.schema).read()
    described = described_table(spark, name)
    partitioned = described.where("col_name = '# Partition Information'").count() == 1
    quality = described.where("col_name = 'Table Properties' AND data_type LIKE '%quality=gold%'").count() == 1
    comment = described.where("col_name = 'Comment'").first().data_type
    return rows.withColumns(
        {"is_partitioned": F.lit(partitioned), "is_gold": F.lit(quality), "comment": F.lit(comment)}
    )
