from gridpulse.sources.files import (
    infer_json_schema,
    pinned_json_schema,
    read_dimension_csv,
    read_json_stream,
    with_rescued_data,
)
from gridpulse.sources.kafka import decode_events, encode_events, kafka_options, read_kafka_stream
from gridpulse.sources.tables import Layer, analyze_table, register_table, write_table

__all__ = [
    "Layer",
    "analyze_table",
    "decode_events",
    "encode_events",
    "infer_json_schema",
    "kafka_options",
    "pinned_json_schema",
    "read_dimension_csv",
    "read_json_stream",
    "read_kafka_stream",
    "register_table",
    "with_rescued_data",
    "write_table",
]
