"""Raw events as columns, with where and when they came in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from gridpulse.functions.times import with_audit
from gridpulse.schemas import TELEMETRY
from gridpulse.sources.files import read_json_stream
from gridpulse.sources.kafka import decode_events


def bronze_from_records(records: DataFrame, schema: StructType = TELEMETRY) -> DataFrame:
    """Kafka records, streaming or not."""
    return with_audit(decode_events(records, schema), "ingested_at")


def bronze_from_files(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    max_files_per_trigger: int | None = None,
    schema_store: str | None = None,
) -> DataFrame:
    """Stream of JSON-line files; ``schema_store`` keeps an inferred schema from one start to the next."""
    return with_audit(read_json_stream(spark, path, schema, max_files_per_trigger, schema_store), "ingested_at")
