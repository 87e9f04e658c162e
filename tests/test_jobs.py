"""Job-level entry points: ingest from parameters, history, object store, command line."""

import os
import subprocess
import sys

import pytest

from lakeferry.operators.messages import encode_messages
from lakeferry.plans.catalog import small_file_table
from lakeferry.plans.jobs import history, start_ingest
from lakeferry.plans.params import IngestParams
from lakeferry.session import configure_object_store, object_store_conf, scratch_path
from lakeferry.sources.synth import messages_from_events
from lakeferry.sources.table import read_table
from lakeferry.sources.topic import publish

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_start_ingest_from_params(spark, sf_small):
    topic, table, cp = (scratch_path(spark, n) for n in ("topic", "table", "cp"))
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    publish(encode_messages(messages_from_events(events)), "key", "value", "m", path=topic)
    params = IngestParams(topic_path=topic, table_path=table, checkpoint=cp)
    start_ingest(spark, params, available_now=True).awaitTermination()
    assert read_table(spark, table).count() == events.count()


def test_ingest_batches_are_bounded(spark, sf_small):
    topic, table, cp = (scratch_path(spark, n) for n in ("topic", "table", "cp"))
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    msgs = encode_messages(messages_from_events(events)).repartition(3)
    publish(msgs, "key", "value", "m", path=topic)
    params = IngestParams(topic_path=topic, table_path=table, checkpoint=cp, max_per_trigger=1)
    q = start_ingest(spark, params, available_now=True)
    q.awaitTermination()
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 3  # one topic file per micro-batch
    assert read_table(spark, table).count() == events.count()


def test_history_needs_delta(spark, sf_small):
    with pytest.raises(NotImplementedError):
        history(spark, small_file_table(spark, sf_small))


def test_object_store_settings_reach_the_session(spark):
    conf = object_store_conf("http://store:9000", "ak", "sk")
    assert conf["fs.s3a.path.style.access"] == "true"
    assert conf["fs.s3a.connection.ssl.enabled"] == "false"
    configure_object_store(spark, {"fs.s3a.endpoint": "http://store:9000"})
    assert spark.conf.get("fs.s3a.endpoint") == "http://store:9000"
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    assert hadoop.get("fs.s3a.endpoint") == "http://store:9000"
    spark.conf.unset("fs.s3a.endpoint")
    hadoop.unset("fs.s3a.endpoint")


def test_command_line_maintain(spark, sf_small):
    path = small_file_table(spark, sf_small)
    out = subprocess.run(
        [sys.executable, "-m", "lakeferry", "maintain", "--table-path", path, "--as-of",
         "2024-01-30", "--days", "2", "--no-vacuum"],
        cwd=ROOT, capture_output=True, text=True, timeout=300,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert "compact: ok" in out.stderr and "total rows: 1000" in out.stderr
    missing = subprocess.run(
        [sys.executable, "-m", "lakeferry", "maintain", "--table-path", scratch_path(spark, "none")],
        cwd=ROOT, capture_output=True, text=True, timeout=300,
    )
    assert missing.returncode == 0 and "guard: no_table" in missing.stderr
