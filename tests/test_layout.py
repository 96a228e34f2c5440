import pytest
from pyspark.sql import functions as F

from gridpulse.operators import cluster_layout, partition_layout, zorder_layout
from gridpulse.session import new_folder
from gridpulse.sources import write_table


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows are copies of one row, another third share one value."""
    copies = spark.range(4000).select(F.lit(5).alias("a"), F.lit(5).alias("b"), F.lit("x").alias("s"))
    shared = spark.range(4000).select(F.lit(7).alias("a"), (F.col("id") % 1000).cast("int").alias("b"), F.lit("y").alias("s"))
    rest = spark.range(4000).select(
        (F.col("id") % 997).cast("int").alias("a"), (F.col("id") * 7 % 1009).cast("int").alias("b"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), F.col("id") % 50)).alias("s"),
    )
    return copies.repartition(16).unionByName(shared).unionByName(rest).cache()


def rows_per_file(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


@pytest.mark.parametrize("layout", [lambda d: cluster_layout(d, ["a"], 6), lambda d: zorder_layout(d, ["a", "b"], 6), lambda d: zorder_layout(d, ["s", "a"], 6)])
def test_layout_keeps_rows_and_splits_hot_values(skewed, layout):
    placed = layout(skewed)
    assert placed.columns == skewed.columns
    assert placed.count() == skewed.count()
    assert placed.exceptAll(skewed).isEmpty()
    sizes = rows_per_file(placed)
    assert len(sizes) == 6 and max(sizes) < skewed.count() / 3


def test_clustered_files_hold_separate_ranges(spark):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_000).alias("v"))
    ranges = cluster_layout(df, ["v"], 8).groupBy(F.spark_partition_id().alias("p")).agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("lo").collect()
    assert len(ranges) == 8 and all(a.hi < b.lo for a, b in zip(ranges, ranges[1:]))


def test_zorder_narrows_both_columns(spark):
    df = spark.range(40_000).select((F.col("id") % 200).alias("a"), F.floor(F.col("id") / 200).alias("b"))
    boxes = zorder_layout(df, ["a", "b"], 16).groupBy(F.spark_partition_id().alias("p")).agg(
        (F.max("a") - F.min("a")).alias("wa"), (F.max("b") - F.min("b")).alias("wb")
    ).collect()
    assert len(boxes) == 16
    # A file of one column's order would span the other column's whole width, 199.
    assert sum(r.wa for r in boxes) / 16 < 120 and sum(r.wb for r in boxes) / 16 < 120


def test_zorder_sees_whole_texts(spark):
    df = spark.range(20_000).select(F.format_string("player_%06d", F.col("id") % 1000).alias("s"), F.floor(F.col("id") / 1000).alias("b"))
    boxes = zorder_layout(df, ["s", "b"], 16).groupBy(F.spark_partition_id().alias("p")).agg(F.countDistinct("s").alias("n")).collect()
    assert len(boxes) == 16 and sum(r.n for r in boxes) / 16 < 600


def test_zorder_of_dates_times_and_constants(spark):
    df = spark.range(300).select(
        F.col("id"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"),
        F.timestamp_seconds("id").alias("t"), F.lit(1).alias("one"), F.lit(None).cast("double").alias("none"),
    )
    for cols in (["d", "t"], ["t", "one"], ["one", "none"], ["none", "id"]):
        placed = zorder_layout(df, cols, 3)
        assert placed.count() == 300 and placed.exceptAll(df).isEmpty()


def test_partitioned_write_has_few_files(spark):
    path = new_folder(spark, "table")
    df = spark.range(3000).repartition(8).select((F.col("id") % 5).alias("g"), F.col("id").alias("v"))
    write_table(df, path=path, partition_by=["g"])
    files = spark.read.parquet(path).select("g", F.col("_metadata.file_path").alias("f")).distinct()
    assert files.groupBy("g").count().agg(F.max("count")).first()[0] == 1
    assert spark.read.parquet(path).count() == 3000


def test_rebalance_is_in_the_plan(spark):
    plan = partition_layout(spark.range(10), ["id"])._jdf.queryExecution().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
