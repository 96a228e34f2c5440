"""The star-schema job and the maintenance job, table by table."""

import pytest
from pyspark.sql import functions as F

from fixtures import event, events
from gridpulse.plans.maintenance import optimize
from gridpulse.plans.separation import GAME_SETTING
from gridpulse.plans.silver import silver_batch
from gridpulse.plans.star_schema import build_dimensions, build_fact, report
from gridpulse.session import new_folder
from gridpulse.sources import Layer, write_table


@pytest.fixture
def csv_folder(tmp_path):
    (tmp_path / "dim_game.csv").write_text(
        "game_id,season,week,home_team,away_team,stadium,turf_type,weather_conditions,temperature_f\ng1,2026,1,A,B,s,t,w,70\n"
    )
    plays = "".join(f"p{i},g1,1,{3 if i < 4 else 1},10,zone,run\n" for i in range(6))
    (tmp_path / "dim_play.csv").write_text(
        "play_id,game_id,quarter,down,distance_to_first,expected_coverage,play_result\n" + plays
    )
    (tmp_path / "dim_player.csv").write_text(
        "player_sk,full_name,team,position,height_in,weight_lbs,college,draft_year\n"
        "w,Wide,A,WR,70,200,c,2020\nc,Corner,B,CB,70,200,c,2020\n"
    )
    return str(tmp_path)


def test_star_schema_end_to_end(spark, csv_folder):
    out = new_folder(spark, "star")
    dimensions = build_dimensions(spark, csv_folder, out)
    assert {name: layer.read().count() for name, layer in dimensions.items()} == {"game": 1, "play": 6, "player": 2}

    rows = [event(p, role, play_id=f"p{i}", x=x * (i + 1)) for i in range(6) for p, role, x in (("w", "WR", 0.0), ("c", "CB", 2.0))]
    silver_path = new_folder(spark, "silver")
    write_table(silver_batch(events(spark, rows)), path=silver_path, partition_by=["game_id"])
    silver = Layer(spark, path=silver_path)
    fact = build_fact(spark, silver, f"{out}/fact", cluster_by=["game_sk"])
    assert fact.read().count() == 6
    found = [tuple(r) for r in report(fact, dimensions).collect()]
    assert found == [("Wide", "A", "Corner", 5.0, 8.0, 4)]

    spark.conf.set(GAME_SETTING, "g2")
    try:
        assert build_fact(spark, silver, f"{out}/fact_g2").read().count() == 0
    finally:
        spark.conf.unset(GAME_SETTING)


def test_optimize_by_path_and_by_name(spark):
    source = new_folder(spark, "source")
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("player_id"), (F.col("id") % 70).alias("v"))
    df.repartition(40).write.parquet(source)
    copy = optimize(Layer(spark, path=source), ["player_id"], new_folder(spark, "copy"), files=4)
    assert copy.read().exceptAll(df).isEmpty() and copy.read().count() == 5000
    files = copy.read().select(F.col("_metadata.file_path").alias("f"), "player_id").groupBy("f").agg(
        F.min("player_id").alias("lo"), F.max("player_id").alias("hi")
    ).orderBy("lo").collect()
    assert len(files) == 4 and all(a.hi < b.lo for a, b in zip(files, files[1:]))

    named = optimize(Layer(spark, path=source), ["player_id", "v"], new_folder(spark, "copy"), name="optimized")
    assert named.read().count() == 5000
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED optimized").collect()}
    assert "5000 rows" in described["Statistics"]


def test_optimize_keeps_a_table_under_its_name(spark):
    df = spark.range(3000).select((F.col("id") % 3).cast("string").alias("game_id"), (F.col("id") * 7 % 1000).alias("player_id"), F.col("id").alias("v"))
    write_table(df, "kept_table", comment="samples", properties={"quality": "silver"}, partition_by=["game_id"])
    layer = optimize(Layer(spark, name="kept_table"), ["player_id"])
    assert layer.name == "kept_table" and layer.read().select(*df.columns).exceptAll(df).isEmpty() and layer.read().count() == 3000
    assert [c.name for c in spark.catalog.listColumns("kept_table") if c.isPartition] == ["game_id"]
    assert spark.catalog.getTable("kept_table").description == "samples"
    assert {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES kept_table").collect()}["quality"] == "silver"
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED kept_table").collect()}
    assert "3000 rows" in described["Statistics"]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("kept_table")] == ["kept_table"]
    spark.sql("DROP TABLE kept_table")


def test_named_tables_of_the_star_schema(spark, csv_folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS stars")
    out = new_folder(spark, "star")
    build_dimensions(spark, csv_folder, out, database="stars")
    assert spark.table("stars.gold_dim_play").count() == 6
    assert spark.catalog.getTable("stars.gold_dim_play").description == "Dimension play, gold"
    counts = {r.rule: (r.passed, r.failed) for r in spark.table("stars.rules_dim_play").collect()}
    assert counts["down_valido"] == (6, 0) and len(counts) == 4
    spark.sql("DROP DATABASE stars CASCADE")
