"""Message transforms: decode/encode topic values, stamp arrival time, derive keys, filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.functions.avro import decode_avro, encode_avro
from lakeferry.schema import MESSAGE_AVRO_SCHEMA, MESSAGE_FIELDS, MESSAGE_TABLE, PARTITION_KEYS


def decode_messages(
    records: DataFrame, mode: str = "FAILFAST", schema_json: str = MESSAGE_AVRO_SCHEMA
) -> DataFrame:
    """Topic records -> flat message rows: decode ``value``, keep only the message fields.

    Key, headers, offsets and broker timestamps are dropped. A null value (tombstone)
    becomes a row of nulls; it is kept, as the ingest job has no filter after decoding.
    """
    return records.select(decode_avro(F.col("value"), schema_json, mode).alias("message")).select(
        "message.*"
    )


def encode_messages(messages: DataFrame, schema_json: str = MESSAGE_AVRO_SCHEMA) -> DataFrame:
    """Message rows -> (key, value): key is the message id, value the Avro body."""
    return messages.select(
        F.col("message_id").cast("binary").alias("key"),
        encode_avro(F.struct(*MESSAGE_FIELDS), schema_json).alias("value"),
    )


def stamp_processing_time(messages: DataFrame) -> DataFrame:
    """Add ``processing_time``: one value per query (per micro-batch in a stream)."""
    return messages.withColumn("processing_time", F.current_timestamp())


def add_partition_columns(messages: DataFrame) -> DataFrame:
    """Copy ``message_type`` and ``date`` into the partition keys; originals stay."""
    return messages.withColumns(
        {PARTITION_KEYS[0]: F.col("message_type"), PARTITION_KEYS[1]: F.col("date")}
    )


def enrich(messages: DataFrame) -> DataFrame:
    """Decoded messages -> rows in stored-table shape and column order."""
    return add_partition_columns(stamp_processing_time(messages)).select(
        *[f.name for f in MESSAGE_TABLE.fields]
    )


def non_blank(column: str | Column) -> Column:
    """Predicate: value is not null and not the empty string."""
    c = F.col(column) if isinstance(column, str) else column
    return c.isNotNull() & (c != F.lit(""))


def blank_where(messages: DataFrame, column: str, condition: Column) -> DataFrame:
    """Replace ``column`` by the empty literal where ``condition`` holds (fixture helper)."""
    return messages.withColumn(column, F.when(condition, F.lit("")).otherwise(F.col(column)))
