"""Schemas of the message record, the stored table and the topic record."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# The producers' Avro record schema. Field order and types decide the
# binary layout, so they must equal what producers write.
MESSAGE_AVRO_SCHEMA = json.dumps(
    {
        "type": "record",
        "name": "Message",
        "namespace": "com.example.avro",
        "fields": [
            {"name": "message_type", "type": "string"},
            {"name": "date", "type": "string"},
            {"name": "message_id", "type": "string"},
            {"name": "creation_time", "type": "long"},
        ],
    }
)

# The two partition columns of the stored table, outer first.
PARTITION_KEYS = ("partition_message_type", "partition_date")

MESSAGE = T.StructType(
    [
        T.StructField("message_type", T.StringType(), True),
        T.StructField("date", T.StringType(), True),
        T.StructField("message_id", T.StringType(), True),
        T.StructField("creation_time", T.LongType(), True),
    ]
)

MESSAGE_FIELDS = tuple(f.name for f in MESSAGE.fields)

# Stored table: message fields, arrival stamp, then copies used as partition keys.
MESSAGE_TABLE = T.StructType(
    list(MESSAGE.fields)
    + [
        T.StructField("processing_time", T.TimestampType(), True),
        T.StructField("partition_message_type", T.StringType(), True),
        T.StructField("partition_date", T.StringType(), True),
    ]
)

# Shape of a record read from a topic (the Kafka source schema).
TOPIC_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("timestampType", T.IntegerType(), True),
    ]
)

_AVRO_TO_SPARK = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType()}


def avro_fields(schema_json: str) -> list[tuple[str, str]]:
    """(name, primitive type) pairs of a flat record schema; rejects anything else."""
    doc = json.loads(schema_json)
    if doc.get("type") != "record":
        raise ValueError("only record schemas are supported")
    out = []
    for f in doc["fields"]:
        t = f["type"]
        if t not in _AVRO_TO_SPARK:
            raise ValueError(f"unsupported Avro type for field {f['name']!r}: {t!r}")
        out.append((f["name"], t))
    return out


def spark_type_of(schema_json: str) -> T.StructType:
    """Spark struct type a record schema decodes to (fields nullable, as Spark does)."""
    return T.StructType(
        [T.StructField(n, _AVRO_TO_SPARK[t], True) for n, t in avro_fields(schema_json)]
    )
