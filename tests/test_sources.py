import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridpulse.plans.bronze import bronze_from_files, bronze_from_records
from gridpulse.schemas import DIM_GAME_CSV, KAFKA_RECORD, TELEMETRY
from gridpulse.session import new_folder
from gridpulse.sources import (
    Layer,
    analyze_table,
    decode_events,
    encode_events,
    infer_json_schema,
    kafka_options,
    read_dimension_csv,
    read_kafka_stream,
    with_rescued_data,
    write_table,
)
from gridpulse.streaming import write_stream

GOOD = {"game_id": "g", "play_id": "p", "player_id": "1", "speed_mph": 7.5, "heart_rate_bpm": 150, "timestamp": 1000}
# An event of another producer: other field names and number ids.
FOREIGN = {
    "game_id": 417, "play_id": 3, "player_id": 88, "lat": 1.5, "lon": -2.25, "pace": 4, "kind": "probe",
}


def as_records(spark, payloads):
    rows = [(b"k", None if p is None else bytearray(p.encode()), "t", 0, i, None) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, KAFKA_RECORD)


def test_decode_good_and_bad_payloads(spark):
    payloads = [
        json.dumps(GOOD), "no json", None, json.dumps({**GOOD, "speed_mph": "7.5"}),
        json.dumps({**GOOD, "heart_rate_bpm": 150.5}), json.dumps({**GOOD, "more": 1}), json.dumps(FOREIGN),
    ]
    rows = decode_events(as_records(spark, payloads)).orderBy("offset").collect()
    assert rows[0].speed_mph == 7.5 and rows[0].heart_rate_bpm == 150 and rows[0].timestamp == 1000
    assert rows[1].game_id is None and rows[2].game_id is None
    assert rows[3].speed_mph is None and rows[3].game_id == "g"
    assert rows[4].heart_rate_bpm is None and rows[4].speed_mph == 7.5
    assert rows[5].speed_mph == 7.5
    assert rows[6].game_id == "417" and rows[6].speed_mph is None and rows[6].heart_rate_bpm is None
    assert decode_events(as_records(spark, [])).columns == [*TELEMETRY.names, "kafka_timestamp", "topic", "partition", "offset"]


def test_bronze_adds_arrival_time(spark):
    row = bronze_from_records(as_records(spark, [json.dumps(GOOD)])).first()
    assert row.ingested_at is not None and row.kafka_timestamp is None


def test_encode_is_undone_by_decode(spark):
    df = spark.createDataFrame([GOOD | {"speed_mph": 1.25}, GOOD | {"player_id": None}], TELEMETRY)
    encoded = encode_events(df.withColumn("topic", F.lit("t")), record_columns=["topic"])
    assert encoded.columns == ["key", "value", "topic"]
    keys = [None if r.key is None else bytes(r.key) for r in encoded.collect()]
    assert keys == [b"1", None]
    records = encoded.select(
        "*", F.lit(0).alias("partition"), F.lit(0).alias("offset"), F.current_timestamp().alias("timestamp")
    )
    assert decode_events(records).select(*TELEMETRY.names).collect() == df.collect()


def test_rescue_of_unknown_and_mistyped_fields(spark):
    texts = [
        '{"a": 1, "b": "x"}', '{"a": "one", "b": "x"}', '{"a": 1, "c": {"d": [1, 2]}, "e": null}', "no json", None, '{"a": null}',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n INT, value STRING")
    rows = with_rescued_data(df, StructType.fromDDL("a INT, b STRING")).orderBy("n").collect()
    assert [(r.a, r.b) for r in rows] == [(1, "x"), (None, "x"), (1, None), (None, None), (None, None), (None, None)]
    assert [r._rescued_data for r in rows] == [None, '{"a":"one"}', '{"c":"{\\"d\\":[1,2]}"}', json.dumps({"_corrupt_record": "no json"}, separators=(",", ":")), None, None]


def test_texts_that_are_no_object_are_kept_whole(spark):
    texts = ["[1, 2]", '{"a": 1', "  ", '"x"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n INT, value STRING")
    rows = with_rescued_data(df, StructType.fromDDL("a INT")).orderBy("n").collect()
    kept = [json.loads(r._rescued_data)["_corrupt_record"] if r._rescued_data else None for r in rows]
    assert kept == ["[1, 2]", '{"a": 1', None, '"x"']


def test_inferred_schema_is_pinned(spark, tmp_path):
    landing, store, out, state = (str(tmp_path / n) for n in ("in", "schema", "out", "state"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"n": 1}\n')
    write_stream(bronze_from_files(spark, landing, schema_store=store), out, state)
    (tmp_path / "in" / "b.json").write_text('{"n": 2, "late_field": true}\n')
    write_stream(bronze_from_files(spark, landing, schema_store=store), out, state)
    rows = {r.n: r._rescued_data for r in spark.read.parquet(out).collect()}
    assert rows == {1: None, 2: '{"late_field":"true"}'}


def test_json_file_stream_with_inferred_schema(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a.json").write_text('{"game_id": "g", "speed_mph": 1.5, "timestamp": 5}\n')
    schema = infer_json_schema(spark, str(landing))
    assert schema["speed_mph"].dataType.simpleString() == "double"
    (landing / "b.json").write_text('{"game_id": "h", "speed_mph": "fast", "status": "new"}\n')
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    bronze = bronze_from_files(spark, str(landing), schema)
    run = write_stream(bronze, out, state)
    assert run.input_rows == 2
    rows = {r.game_id: r for r in spark.read.parquet(out).collect()}
    assert rows["g"].speed_mph == 1.5 and rows["g"]._rescued_data is None and rows["g"].source_file.endswith("/a.json")
    assert rows["h"].speed_mph is None
    assert json.loads(rows["h"]._rescued_data) == {"speed_mph": "fast", "status": "new"}
    assert write_stream(bronze, out, state).input_rows == 0
    assert spark.read.parquet(out).count() == 2


def test_schema_is_inferred_when_none_is_given(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"n": 1}\n{"n": 2}\n')
    stream = bronze_from_files(spark, str(tmp_path))
    assert stream.isStreaming and dict(stream.dtypes)["n"] == "bigint"


def test_dimension_csv_is_text(spark, tmp_path):
    (tmp_path / "dim_game.csv").write_text(",".join(DIM_GAME_CSV.names) + "\ng,2024,1,A,B,s,t,w,70\n")
    df = read_dimension_csv(spark, str(tmp_path / "dim_game.csv"), DIM_GAME_CSV)
    assert {t for _, t in df.dtypes} == {"string"}
    assert df.first().season == "2024"


def test_kafka_options():
    plain = kafka_options("host:9092", "events")
    assert plain["subscribe"] == "events" and plain["startingOffsets"] == "latest" and plain["failOnDataLoss"] == "false"
    assert not any("sasl" in name for name in plain)
    secured = kafka_options("host:9092", "events", "me", "secret", startingOffsets="earliest", kafka__client__id="c")
    assert secured["kafka.security.protocol"] == "SASL_SSL" and secured["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="me" password="secret"' in secured["kafka.sasl.jaas.config"]
    quoted = kafka_options("h", "t", "me", 'a"b\\c')["kafka.sasl.jaas.config"]
    assert quoted.endswith('password="a\\"b\\\\c";')
    assert secured["startingOffsets"] == "earliest" and secured["kafka.client.id"] == "c"


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka_stream(spark, kafka_options("localhost:9", "events"))


def test_catalog_table_with_comment_properties_and_statistics(spark):
    path = new_folder(spark, "table")
    df = spark.range(30).select((F.col("id") % 3).alias("game_id"), F.col("id").alias("v"))
    write_table(df, "tracked", path, comment="it's raw", properties={"quality": "gold", "owner's": "x"}, partition_by=["game_id"])
    assert Layer(spark, name="tracked").read().count() == 30
    assert spark.catalog.getTable("tracked").description == "it's raw"
    properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES tracked").collect()}
    assert properties["quality"] == "gold" and properties["owner's"] == "x"
    analyze_table(spark, "tracked", columns=["v"])
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED tracked").collect()}
    assert "30 rows" in described["Statistics"]
    write_table(df.limit(5), "tracked", path)
    assert spark.table("tracked").count() == 5


def test_partitioned_read_prunes(spark):
    path = new_folder(spark, "table")
    df = spark.range(40).select((F.col("id") % 4).cast("string").alias("game_id"), F.col("id").alias("v"))
    write_table(df, path=path, partition_by=["game_id"])
    read = Layer(spark, path=path, schema=df.schema).read().where("game_id = '2'")
    plan = read._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(game_id" in plan
    assert read.count() == 10 and read.schema["game_id"].dataType.simpleString() == "string"


def test_long_arrays_lie_in_small_row_groups(spark, tmp_path):
    """A reader unpacks a row group at once, up to 4,096 rows of it."""
    long = spark.range(30, numPartitions=1).select("id", F.transform(F.sequence(F.lit(1), F.lit(100_000)), lambda x: F.xxhash64("id", x)).alias("a"))
    write_table(long, path=str(tmp_path / "long"))
    (file,) = (tmp_path / "long").glob("*.parquet")
    assert pq.ParquetFile(file).metadata.num_row_groups >= 3
    assert spark.read.parquet(str(tmp_path / "long")).exceptAll(long).count() == 0


def test_layer_streams_and_argument_checks(spark):
    path = new_folder(spark, "layer")
    spark.range(4).write.parquet(path)
    layer = Layer(spark, path=path)
    assert layer.read_stream(max_files_per_trigger=1).isStreaming
    with pytest.raises(ValueError):
        Layer(spark)
    with pytest.raises(ValueError):
        write_table(spark.range(1), path=path, comment="c")
    with pytest.raises(ValueError):
        write_table(spark.range(1))
