"""JSON-line streams with a rescue column, and dimension CSVs."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RESCUED = "_rescued_data"


def infer_json_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> StructType:
    """Types found in the files now there. Pin the result: a stream keeps one schema.

    A field missed by sampling is not lost, it goes to the rescue column.
    """
    return spark.read.option("samplingRatio", sampling_ratio).json(path).schema


def pinned_json_schema(spark: SparkSession, path: str, store: str, sampling_ratio: float = 1.0) -> StructType:
    """The schema kept in folder ``store``; inferred from the files now there and stored at the first call."""
    try:
        return StructType.fromJson(json.loads(spark.read.text(store, wholetext=True).first()[0]))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    schema = infer_json_schema(spark, path, sampling_ratio)
    spark.range(1).select(F.lit(schema.json()).alias("value")).write.text(store)
    return schema


def read_json_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    max_files_per_trigger: int | None = None,
    schema_store: str | None = None,
) -> DataFrame:
    """Stream of JSON-line files: typed columns, ``_rescued_data`` and ``source_file``.

    Without ``schema`` it is inferred from the files now there. With ``schema_store``, a folder beside
    the stream's checkpoint, that happens once: later starts read it there, and new fields are rescued.
    """
    if schema is None and schema_store:
        schema = pinned_json_schema(spark, path, schema_store)
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(path).withColumn("source_file", F.col("_metadata.file_path"))
    return with_rescued_data(lines, schema or infer_json_schema(spark, path))


def with_rescued_data(df: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Parses JSON text ``value`` into the columns of ``schema``; the other columns stay.

    ``_rescued_data`` holds, as JSON text, the fields that the schema lacks and those whose value
    does not fit their type; NULL when there are none. A text that is no JSON object is kept whole, as
    its one field ``_corrupt_record``.
    """
    text = F.col(value).cast("string")
    fields = [(f.name, F.col("_typed")[f.name]) for f in schema.fields]
    fitting = F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(v.isNotNull(), F.lit(n)) for n, v in fields]))
    lost = F.map_filter("_raw", lambda k, v: v.isNotNull() & ~F.array_contains(F.col("_fitting"), k))
    unreadable = F.col("_raw").isNull() & (F.trim(text) != "")
    corrupt = F.when(unreadable, F.to_json(F.create_map(F.lit("_corrupt_record"), text)))
    parsed = (
        df.withColumn("_typed", F.from_json(text, schema))
        .withColumn("_raw", F.from_json(text, "map<string,string>"))
        .withColumn("_fitting", fitting)
        # As many fields as fitting columns: all have arrived, which is the common case.
        .withColumn("_lost", F.when(F.size("_raw") != F.size("_fitting"), lost))
    )
    others = [c for c in df.columns if c != value]
    return parsed.select(
        *[v.alias(n) for n, v in fields],
        F.when(F.size("_lost") > 0, F.to_json("_lost")).otherwise(corrupt).alias(RESCUED),
        *others,
    )


def read_dimension_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header, every column text; types come later, so no inference pass is needed."""
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)
