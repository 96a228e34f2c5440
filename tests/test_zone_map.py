"""Zone maps: no row is missed, and fewer files are opened after a Z-order."""

import pytest
from pyspark.sql import functions as F

from gridpulse.operators.layout import zorder_layout
from gridpulse.session import new_folder
from gridpulse.sources.tables import Layer, write_table
from gridpulse.sources.zone_map import ZoneMap


@pytest.fixture(scope="module")
def rows(spark):
    key = (F.col("id") * 7919) % 20_000
    return spark.range(20_000).select(
        (key % 200).alias("a"), F.floor(key / 200).alias("b"), F.format_string("name %05d", key).alias("name"),
        F.when(key % 3 > 0, key * 10).alias("code"), F.when(key > 9, key / 4).alias("x"),
    )


def mapped(spark, df, partition_by=()):
    path = new_folder(spark, "table")
    write_table(df, path=path, partition_by=partition_by)
    layer = Layer(spark, path=path, schema=df.schema)
    return ZoneMap.build(layer, f"{path}-map", ranges=["a", "b", "x"], members=["name", "code"], bitmaps=4)


def sorted_rows(df):
    return sorted(map(str, df.select("a", "b", "name", "code", "x").collect()))


def test_fewer_files_after_a_zorder(spark, rows):
    scattered, ordered = mapped(spark, rows.repartition(16)), mapped(spark, zorder_layout(rows, ["a", "b"], 16))
    box = {"a": (20, 40), "b": (10, 25)}
    assert scattered.files(box).count() == 16 and ordered.files(box).count() <= 5
    expected = sorted_rows(rows.where("a BETWEEN 20 AND 40 AND b BETWEEN 10 AND 25"))
    assert sorted_rows(scattered.read(box)) == expected == sorted_rows(ordered.read(box)) and expected
    # The scan itself lists only those files.
    assert len(ordered.read(box).inputFiles()) == ordered.files(box).count()


def test_members_are_found_where_they_are(spark, rows):
    zones = mapped(spark, zorder_layout(rows, ["a", "b"], 16))
    names = ["name 00007", "name 19999", "no such name"]
    assert 1 <= zones.files(equals={"name": names}).count() <= 6
    assert sorted_rows(zones.read(equals={"name": names})) == sorted_rows(rows.where(F.col("name").isin(names)))
    assert zones.read(equals={"name": ["nobody at all"], "code": [-1]}).count() == 0
    both = {"code": [70, 71, 199_990]}
    assert sorted_rows(zones.read({"a": (0, 199)}, both)) == sorted_rows(rows.where(F.col("code").isin(70, 71, 199_990)))


def test_partitions_and_empty_tables(spark, rows):
    zones = mapped(spark, rows.where("a < 3").withColumn("part", F.col("a") % 2), ["part"])
    assert zones.read({"a": (1, 1)}).select("part").distinct().collect()[0].part == 1
    empty = mapped(spark, rows.where("a < 0"))
    assert empty.read({"a": (0, 10)}).count() == 0 and empty.read(equals={"code": [1]}).columns == rows.columns
