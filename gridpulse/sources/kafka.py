"""Kafka records: connection options, decoding into event columns, and encoding.

The connector is a separate Spark package; nothing here needs it except ``read_kafka_stream``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridpulse.schemas import TELEMETRY


def kafka_options(
    servers: str, topic: str, username: str | None = None, password: str | None = None, **extra: str
) -> dict[str, str]:
    """Options of a one-topic stream: start at the latest offsets, go on after lost data.

    With a user name the connection uses SASL over TLS. ``extra`` overrides anything, with ``__``
    for dots, e.g. ``startingOffsets="earliest"`` or ``maxOffsetsPerTrigger="1000000"``.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    if username is not None:
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        user, secret = (str(x).replace("\\", "\\\\").replace('"', '\\"') for x in (username, password))
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": f'{login} required username="{user}" password="{secret}";',
        }
    return options | {name.replace("__", "."): value for name, value in extra.items()}


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def decode_events(records: DataFrame, schema: StructType = TELEMETRY) -> DataFrame:
    """Event columns from the JSON in ``value``, with the record's own metadata.

    Text that is no JSON gives NULL columns, a field of the wrong type a NULL field. The record time
    becomes ``kafka_timestamp``, since events have a ``timestamp`` of their own.
    """
    event = F.from_json(F.col("value").cast("string"), schema)
    return records.withColumn("_event", event).select(
        "_event.*", F.col("timestamp").alias("kafka_timestamp"), "topic", "partition", "offset"
    )


def encode_events(df: DataFrame, key: str = "player_id", record_columns: Sequence[str] = ()) -> DataFrame:
    """Rows as keyed JSON records (``key``, ``value``), ready for ``write.format("kafka")``.

    ``record_columns`` (``topic``, ``partition``, ...) stay columns of the record, outside the JSON.
    """
    payload = [c for c in df.columns if c not in record_columns]
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*payload)).cast("binary").alias("value"),
        *record_columns,
    )
