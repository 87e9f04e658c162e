"""Decode, enrich and filter transforms on Spark (the ingest job's per-row work)."""

import pytest
from pyspark.sql import functions as F

from lakeferry.functions.avro import decode_avro, encode_avro
from lakeferry.operators.messages import (
    add_partition_columns,
    decode_messages,
    encode_messages,
    enrich,
    non_blank,
)
from lakeferry.schema import MESSAGE_AVRO_SCHEMA, MESSAGE_TABLE, PARTITION_KEYS
from lakeferry.sources.synth import literal_messages, messages_from_events

ROWS = [
    ("préfixe/é", "not a date", "m" * 200, -5),  # a two-byte length, multi-byte UTF-8
    ("", "2031-07-04", "Ω", 2**62),
    ("plain", "", "", -(2**63)),
]


def test_partition_columns_copy_the_source(spark):
    df = add_partition_columns(literal_messages(spark, [*ROWS, (None, None, "x", None)]))
    assert df.count() == 4
    for key, source in zip(PARTITION_KEYS, ("message_type", "date")):
        assert df.where(~F.col(key).eqNullSafe(F.col(source))).count() == 0


def test_empty_input_keeps_columns(spark):
    df = enrich(literal_messages(spark, []))
    assert df.count() == 0
    assert df.columns == [f.name for f in MESSAGE_TABLE.fields]


def test_enrich_stamps_every_row_once(spark):
    df = enrich(literal_messages(spark, ROWS * 3))
    assert sorted(r[0] for r in df.select(PARTITION_KEYS[0]).collect()) == sorted(
        t for t, *_ in ROWS * 3)
    assert df.where(F.col("processing_time").isNull()).count() == 0
    assert df.select("processing_time").distinct().count() == 1


def test_avro_schema_text():
    assert '"message_type"' in MESSAGE_AVRO_SCHEMA and '"long"' in MESSAGE_AVRO_SCHEMA


def test_round_trip_on_events(spark, sf_small):
    msgs = messages_from_events(spark.read.parquet(f"{sf_small}/events.parquet"))
    back = decode_messages(encode_messages(msgs))
    assert back.columns == msgs.columns
    assert back.exceptAll(msgs).count() == 0 and msgs.exceptAll(back).count() == 0


def test_tombstone_decodes_to_nulls(spark):
    df = spark.createDataFrame([(None,)], "value binary")
    row = decode_messages(df).collect()[0]
    assert all(v is None for v in row)


def test_failfast_and_permissive(spark):
    good = encode_messages(literal_messages(spark, ROWS)).select("value")
    bad = spark.createDataFrame([(bytearray(b"\x10abc"),)], "value binary")
    mixed = good.unionByName(bad)
    with pytest.raises(Exception, match="Malformed"):
        decode_messages(mixed).collect()
    rows = decode_messages(mixed, mode="PERMISSIVE").collect()
    assert sorted(r.message_id for r in rows if r.message_id is not None) == sorted(
        r[2] for r in ROWS)
    assert sum(1 for r in rows if r.message_id is None) == 1


def test_column_api(spark):
    df = literal_messages(spark, ROWS)
    enc = df.select(encode_avro(F.struct(*df.columns)).alias("v"))
    dec = enc.select(decode_avro("v").alias("m")).select("m.*")
    assert sorted(map(tuple, dec.collect())) == sorted(ROWS)
    with pytest.raises(ValueError):
        decode_avro("v", mode="DROPMALFORMED")


def test_non_blank(spark):
    rows = [*ROWS, (None, "d", "no type", 3), (" ", "d", "a space", 4)]
    df = literal_messages(spark, rows).where(non_blank("message_type"))
    assert {r.message_type for r in df.collect()} == {"préfixe/é", "plain", " "}
