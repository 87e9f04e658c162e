"""Avro decode / encode as Column functions.

With Spark's Avro module on the class path (``--packages org.apache.spark:spark-avro_2.13``)
these are the built-in ``from_avro`` / ``to_avro`` expressions. Without it they fall back to
Arrow-batched UDFs over the vectorised codec in :mod:`lakeferry.functions.avro_codec` — same
results, same null and failure semantics, still one Arrow batch per call.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions import avro_codec
from lakeferry.schema import MESSAGE_AVRO_SCHEMA, avro_fields, spark_type_of
from lakeferry.session import _probe

MODES = ("FAILFAST", "PERMISSIVE")


def avro_native(spark: SparkSession | None = None) -> bool:
    """True when Spark's own Avro functions can be used in this session."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return False

    def check():
        from pyspark.sql.avro.functions import to_avro

        spark.range(0).select(to_avro(F.struct(F.lit("x").alias("s")))).schema

    return _probe(spark, "avro", check)


def _decoder(schema_json: str, failfast: bool):
    fields = avro_fields(schema_json)
    rtype = spark_type_of(schema_json)

    @F.arrow_udf(rtype)
    def decode_avro(values: pa.Array) -> pa.Array:
        return avro_codec.decode(values, fields, failfast=failfast)

    return decode_avro


def _encoder(schema_json: str):
    fields = avro_fields(schema_json)

    @F.arrow_udf(T.BinaryType())
    def encode_avro(records: pa.Array) -> pa.Array:
        return avro_codec.encode(records, fields)

    return encode_avro


def decode_avro(
    value: Column | str,
    schema_json: str = MESSAGE_AVRO_SCHEMA,
    mode: str = "FAILFAST",
    native: bool | None = None,
) -> Column:
    """Binary Avro column -> struct column (the ``from_avro`` contract).

    ``FAILFAST`` (default) fails the query on the first malformed record; ``PERMISSIVE``
    turns malformed records into a null struct. A null value decodes to a null struct.
    """
    mode = mode.upper()
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    col = F.col(value) if isinstance(value, str) else value
    if avro_native() if native is None else native:
        from pyspark.sql.avro.functions import from_avro

        return from_avro(col, schema_json, {"mode": mode})
    return _decoder(schema_json, mode == "FAILFAST")(col)


def encode_avro(
    record: Column, schema_json: str = MESSAGE_AVRO_SCHEMA, native: bool | None = None
) -> Column:
    """Struct column -> binary Avro column (the ``to_avro`` contract)."""
    if avro_native() if native is None else native:
        from pyspark.sql.avro.functions import to_avro

        return to_avro(record, schema_json)
    return _encoder(schema_json)(record)
