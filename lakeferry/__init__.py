"""lakeferry: ingest Avro messages from a topic into a partitioned lake table and keep
that table healthy (compaction, vacuum, statistics), expressed with Spark DataFrames and
Structured Streaming."""

from lakeferry.schema import (
    MESSAGE,
    MESSAGE_AVRO_SCHEMA,
    MESSAGE_TABLE,
    PARTITION_KEYS,
    TOPIC_RECORD,
)
from lakeferry.session import build_session, scratch_path

__all__ = [
    "MESSAGE",
    "MESSAGE_AVRO_SCHEMA",
    "MESSAGE_TABLE",
    "PARTITION_KEYS",
    "TOPIC_RECORD",
    "build_session",
    "scratch_path",
]
