"""Topic connector: Kafka when its source is on the class path, else a Parquet directory
of Kafka-shaped records (``key, value, topic, partition, offset, timestamp,
timestampType``) that plays the topic offline. Both read and publish keep the record
shape, so everything downstream is the same code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.schema import TOPIC_RECORD
from lakeferry.session import kafka_available


def _need_kafka(spark: SparkSession, topic: str | None, brokers: str | None) -> None:
    if not (topic and brokers):
        raise ValueError("give topic and brokers, or an offline topic path")
    if not kafka_available(spark):
        raise RuntimeError(
            "the Kafka source is not on the class path; start Spark with "
            "--packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>"
        )


def read_topic_stream(
    spark: SparkSession,
    topic: str | None = None,
    brokers: str | None = None,
    path: str | None = None,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Unbounded read of one topic.

    Kafka: ``subscribe`` to ``topic`` on the comma-separated ``brokers`` list, starting at
    ``starting_offsets`` when no checkpoint exists, tolerating expired offsets unless
    ``fail_on_data_loss``. Offline (``path`` given): a file stream over the topic directory;
    ``max_per_trigger`` bounds files per micro-batch.
    """
    if path is not None:
        r = spark.readStream.schema(TOPIC_RECORD)
        if max_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_per_trigger))
        return r.parquet(path)
    _need_kafka(spark, topic, brokers)
    r = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
    return r.load()


def read_topic_batch(
    spark: SparkSession,
    topic: str | None = None,
    brokers: str | None = None,
    path: str | None = None,
    starting_offsets: str = "earliest",
    ending_offsets: str = "latest",
) -> DataFrame:
    """Bounded slice of a topic (earliest to latest by default)."""
    if path is not None:
        return spark.read.schema(TOPIC_RECORD).parquet(path)
    _need_kafka(spark, topic, brokers)
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("endingOffsets", ending_offsets)
        .load()
    )


def publish(
    df: DataFrame,
    key: Column | str,
    value: Column | str,
    topic: str,
    brokers: str | None = None,
    path: str | None = None,
    num_partitions: int = 8,
) -> None:
    """Write records to a topic: ``key`` and ``value`` binary (or string) columns.

    Kafka: the Spark Kafka sink with ``acks=all``. Offline: append Kafka-shaped rows to
    ``path``; the topic partition is the key's hash modulo ``num_partitions`` (as a keyed
    producer does), the offset is unique and increasing per write task (not dense).
    """
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    records = df.select(k.cast("binary").alias("key"), v.cast("binary").alias("value"))
    if path is None:
        if not brokers:
            raise ValueError("give brokers, or an offline topic path")
        (
            records.write.format("kafka")
            .option("kafka.bootstrap.servers", brokers)
            .option("kafka.acks", "all")
            .option("topic", topic)
            .save()
        )
        return
    shaped = records.select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64("key"), F.lit(num_partitions)).cast("int").alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    shaped.write.mode("append").parquet(path)
