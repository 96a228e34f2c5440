"""Schemas that follow the data: fields found in the rescue column become columns of the next version."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegralType,
    LongType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

from gridpulse.sources.files import RESCUED, infer_json_schema, read_json_stream
from gridpulse.streaming.runs import StreamRun, process_stream

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class SchemaLog:
    """The versions of a schema, numbered from 1, as rows of a table in ``folder``. Versions are only added."""

    spark: SparkSession
    folder: str

    def versions(self) -> dict[int, StructType]:
        try:
            rows = self.spark.read.schema("version INT, fields STRING").parquet(self.folder).collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {r.version: StructType.fromJson(json.loads(r.fields)) for r in sorted(rows)}

    def latest(self) -> tuple[int, StructType] | None:
        return max(self.versions().items(), key=lambda v: v[0], default=None)

    def add(self, schema: StructType) -> int:
        """The number of ``schema``, which becomes the latest version unless it is that already."""
        last = self.latest()
        if last and last[1] == schema:
            return last[0]
        version = last[0] + 1 if last else 1
        row = self.spark.range(1).select(F.lit(version).alias("version"), F.lit(schema.json()).alias("fields"))
        row.write.mode("append").parquet(self.folder)
        return version


def found_fields(rescued: DataFrame) -> DataFrame:
    """Rows (name, n, whole, number, truth): the rescued fields, how often each came, and what all its values fit."""
    value = F.col("value")
    entries = rescued.where(F.col(RESCUED).isNotNull()).select(F.explode(F.from_json(RESCUED, "map<string,string>")).alias("name", "value"))
    return (
        entries.where((F.col("name") != CORRUPT) & value.isNotNull())
        .groupBy("name")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bool_and(value.try_cast("bigint").isNotNull() & value.rlike("^-?[0-9]+$")).alias("whole"),
            F.bool_and(value.try_cast("double").isNotNull()).alias("number"),
            F.bool_and(value.isin("true", "false")).alias("truth"),
        )
    )


def evolved_schema(schema: StructType, rescued: DataFrame) -> StructType:
    """``schema`` with the fields in the rescue column of ``rescued``.

    New fields come last, by name, as whole numbers, numbers, truth values or text, whichever all their values fit. A
    column whose values did not all fit becomes wide enough for them: a whole number long or double, anything else text.
    """
    found = {r["name"]: r for r in found_fields(rescued).collect()}  # one row a field, as the schema itself
    fields = [StructField(f.name, _wider(f.dataType, found[f.name])) if f.name in found else f for f in schema.fields]
    new = sorted(set(found) - set(schema.names))
    return StructType([*fields, *[StructField(name, _kind(found[name])) for name in new]])


def _kind(found) -> DataType:
    if found["whole"]:
        return LongType()
    return DoubleType() if found["number"] else BooleanType() if found["truth"] else StringType()


def _wider(known: DataType, found) -> DataType:
    if isinstance(known, IntegralType) and found["whole"]:
        return LongType()
    return DoubleType() if isinstance(known, NumericType) and found["number"] else StringType()


def with_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows read under an older version as rows of ``schema``: its columns filled from the rescue column, which keeps the rest."""
    lost = F.from_json(RESCUED, "map<string,string>")
    columns, taken = [], []
    for f in schema.fields:
        own = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        value = F.coalesce(own, F.get(F.array(lost[f.name]), F.lit(0)).try_cast(f.dataType))
        columns.append(value.alias(f.name))
        taken.append(F.when(value.isNotNull(), F.lit(f.name)))
    names = F.array_compact(F.array(F.lit(None).cast("string"), *taken))
    rest = F.map_filter(lost, lambda k, v: ~F.array_contains(names, k))
    others = [c for c in df.columns if c not in schema.names and c != RESCUED]
    return df.select(*columns, F.when(F.size(rest) > 0, F.to_json(rest)).alias(RESCUED), *others)


@dataclass(frozen=True)
class EvolvingTable:
    """JSON files of folder ``landing`` as a table in ``base`` whose columns follow the files.

    Each run reads the new files under the latest version and writes them beside what earlier versions wrote; what they
    brought that this version lacks makes the next one. ``read`` gives all rows under the latest.
    """

    spark: SparkSession
    landing: str
    base: str

    @property
    def log(self) -> SchemaLog:
        return SchemaLog(self.spark, f"{self.base}/schemas")

    def run(self, max_files_per_trigger: int | None = None) -> StreamRun:
        version, schema = self.log.latest() or (None, infer_json_schema(self.spark, self.landing))
        version = version or self.log.add(schema)
        stream = read_json_stream(self.spark, self.landing, schema, max_files_per_trigger)
        folder = self._folder(version)

        def write(rows: DataFrame, batch: int) -> None:
            # A repeated batch replaces what its first attempt wrote.
            dated = rows.withColumn("arrival", F.lit(batch))
            dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("arrival").parquet(folder)

        done = process_stream(stream, write, f"{self.base}/checkpoint")
        if done.input_rows:
            self.log.add(evolved_schema(schema, self._rows(version, schema)))
        return done

    def read(self) -> DataFrame:
        """All rows as the latest version has them, with ``source_file``, ``_rescued_data`` and ``arrival``."""
        versions = self.log.versions()
        latest = versions[max(versions)]
        parts = [with_schema(rows, latest) for v, s in versions.items() if (rows := self._rows(v, s)) is not None]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def _folder(self, version: int) -> str:
        return f"{self.base}/version-{version}"

    def _rows(self, version: int, schema: StructType) -> DataFrame | None:
        whole = StructType([*schema.fields, *StructType.fromDDL(f"{RESCUED} STRING, source_file STRING, arrival INT").fields])
        try:
            return self.spark.read.schema(whole).parquet(self._folder(version))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
