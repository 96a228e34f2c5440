"""Tables between the layers: by catalog name, or by folder."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, StructType

from gridpulse.operators.layout import cluster_layout, partition_layout

# A reader unpacks up to 4,096 rows of a row group at once; rows with long arrays get small row groups, measured row by row.
ARRAY_OPTIONS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1"}


@dataclass(frozen=True)
class Layer:
    """A catalog table (``name``) or a parquet folder (``path``), read whole or as a stream."""

    spark: SparkSession
    name: str | None = None
    path: str | None = None
    schema: StructType | None = None

    def __post_init__(self) -> None:
        if (self.name is None) == (self.path is None):
            raise ValueError("give either name or path")

    def read(self) -> DataFrame:
        if self.name:
            return self.spark.read.table(self.name)
        reader = self.spark.read.schema(self.schema) if self.schema else self.spark.read
        return reader.parquet(self.path)

    def read_stream(self, max_files_per_trigger: int | None = None) -> DataFrame:
        reader = self.spark.readStream
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        if self.name:
            return reader.table(self.name)
        return reader.schema(self.schema or self.read().schema).parquet(self.path)


def write_table(
    df: DataFrame,
    name: str | None = None,
    path: str | None = None,
    comment: str | None = None,
    properties: dict[str, str] | None = None,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    written_by: Sequence[str] = (),
) -> None:
    """Replaces a table with ``df``. Comment and properties need a catalog ``name``.

    With both name and path the table lies at that path. ``written_by`` are partition columns of rows that
    already lie as they should.
    """
    if name is None and path is None:
        raise ValueError("give name, path or both")
    if name is None and (comment or properties):
        raise ValueError("comment and properties need a catalog name")
    if cluster_by:
        df = cluster_layout(df, [*partition_by, *cluster_by])
    elif partition_by:
        df = partition_layout(df, partition_by)
    writer = df.write.format("parquet").mode("overwrite")
    if any(isinstance(f.dataType, ArrayType) for f in df.schema.fields):
        writer = writer.options(**ARRAY_OPTIONS)
    if partition_by or written_by:
        writer = writer.partitionBy(*(partition_by or written_by))
    if name is None:
        writer.save(path)
        return
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    spark = df.sparkSession
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS :text", args={"text": comment})
    if properties:
        pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def register_table(spark: SparkSession, name: str, path: str, comment: str, properties: dict[str, str]) -> None:
    """Points catalog table ``name`` at the parquet folder ``path``, replacing what the name meant before."""
    pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_quoted(path)} COMMENT {_quoted(comment)} TBLPROPERTIES ({pairs})")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def analyze_table(spark: SparkSession, name: str, columns: Sequence[str] = ()) -> None:
    """Row count and size for the optimizer; with ``columns`` also their ranges and distinct counts."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    if columns:
        listed = ", ".join(f"`{c}`" for c in columns)
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {listed}")


def _quoted(text: str) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"
