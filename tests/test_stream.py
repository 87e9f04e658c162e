"""End to end: publish -> file stream -> decode -> enrich -> partitioned table; restart."""

import pytest
from pyspark.sql import functions as F

from lakeferry.operators.messages import encode_messages
from lakeferry.operators.stats import partition_row_counts
from lakeferry.session import scratch_path
from lakeferry.sources.synth import literal_messages, messages_from_events, with_types
from lakeferry.sources.table import read_table
from lakeferry.sources.topic import publish, read_topic_stream
from lakeferry.streaming.ingest import append_stream, message_stream


def _run(spark, topic, table, checkpoint):
    q = append_stream(message_stream(read_topic_stream(spark, path=topic)), table, checkpoint,
                      available_now=True)
    q.awaitTermination()
    return q


def test_three_messages_end_to_end(spark):
    topic, table, cp = (scratch_path(spark, n) for n in ("topic", "table", "cp"))
    msgs = with_types(spark, ["user_event", "system_event", "user_event"], date="2024-01-15")
    publish(encode_messages(msgs), "key", "value", "test-messages", path=topic)
    _run(spark, topic, table, cp)
    t = read_table(spark, table)
    assert t.count() == 3
    assert t.where(F.col("partition_message_type") == "user_event").count() == 2
    assert t.where(F.col("partition_message_type") == "system_event").count() == 1
    assert t.where(F.col("processing_time").isNull()).count() == 0


def test_restart_adds_nothing_then_exactly_the_new(spark, sf_small):
    topic, table, cp = (scratch_path(spark, n) for n in ("topic", "table", "cp"))
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    publish(encode_messages(messages_from_events(events)), "key", "value", "m", path=topic)
    _run(spark, topic, table, cp)
    n = events.count()
    assert read_table(spark, table).count() == n
    _run(spark, topic, table, cp)  # same checkpoint, nothing new
    assert read_table(spark, table).count() == n
    extra = literal_messages(spark, [("click", "2024-01-31", f"new{i}", i) for i in range(7)])
    publish(encode_messages(extra), "key", "value", "m", path=topic)
    _run(spark, topic, table, cp)
    t = read_table(spark, table)
    assert t.count() == n + 7
    assert partition_row_counts(t).where("partition_date = '2024-01-31'").first()["row_count"] == 7


def _rows_of(spark, ids, type_="a"):
    from lakeferry.operators.messages import enrich

    return enrich(literal_messages(spark, [(type_, "2024-01-01", i, 1) for i in ids]))


def _writer(table, cp):
    from lakeferry.streaming.ingest import _parquet_batch_writer

    return _parquet_batch_writer(table, cp, optimize_write=True)


def test_a_replay_replaces_exactly_its_batch(spark):
    table, cp = scratch_path(spark, "table"), scratch_path(spark, "cp")
    write = _writer(table, cp)
    write(_rows_of(spark, ["before"]), 0)
    write(_rows_of(spark, [f"old{i}" for i in range(5)], "only_in_the_old"), 1)
    write(_rows_of(spark, [f"new{i}" for i in range(7)]), 1)
    write(_rows_of(spark, [f"new{i}" for i in range(7)]), 1)
    got = sorted(r.message_id for r in read_table(spark, table).collect())
    assert got == ["before"] + [f"new{i}" for i in range(7)]
    write(_rows_of(spark, []), 1)
    assert read_table(spark, table).count() == 1


@pytest.mark.parametrize("dies", ["before", "after"])
def test_batch_arrives_once_wherever_the_job_dies(spark, sf_small, monkeypatch, dies):
    from lakeferry.operators.messages import enrich
    from lakeferry.streaming import ingest

    table, cp = scratch_path(spark, "table"), scratch_path(spark, "cp")
    rows = enrich(messages_from_events(spark.read.parquet(f"{sf_small}/events.parquet")))
    extra = enrich(literal_messages(spark, [("a b/c", "2024-01-01", "e1", 1), ("x:y=%", "", "e2", 2)]))
    rows, n = rows.unionByName(extra), rows.count() + 2
    write = _writer(table, cp)
    write(rows, 0)
    write_table = ingest.write_table

    def die(df, *args):
        if dies == "after":
            write_table(df.limit(20), *args)  # other rows than the replay's
        raise RuntimeError("died")

    with monkeypatch.context() as m:
        m.setattr(ingest, "write_table", die)
        with pytest.raises(RuntimeError, match="died"):
            write(rows, 1)
    write(rows, 1)  # the replay after a restart
    t = read_table(spark, table)
    assert t.count() == 2 * n
    assert t.groupBy("message_id").count().where("count <> 2").count() == 0
    assert t.where("partition_message_type in ('a b/c', 'x:y=%')").count() == 4


def test_a_new_checkpoint_replaces_nothing(spark):
    topic, table = scratch_path(spark, "topic"), scratch_path(spark, "table")
    publish(encode_messages(with_types(spark, ["a", "b"], date="2024-01-15")), "key", "value", "t",
            path=topic)
    _run(spark, topic, table, scratch_path(spark, "cp"))
    _run(spark, topic, table, scratch_path(spark, "cp"))  # started over: its own batches
    assert read_table(spark, table).count() == 4


def test_stream_appends_to_a_table_written_by_a_job(spark, sf_small):
    from lakeferry.operators.compact import compact_all, file_counts
    from lakeferry.operators.messages import enrich
    from lakeferry.sources.table import path_exists, write_table

    topic, table, cp = (scratch_path(spark, n) for n in ("topic", "table", "cp"))
    msgs = messages_from_events(spark.read.parquet(f"{sf_small}/events.parquet"))
    write_table(enrich(msgs), table)
    publish(encode_messages(msgs).repartition(3), "key", "value", "m", path=topic)
    q = append_stream(message_stream(read_topic_stream(spark, path=topic, max_per_trigger=1)),
                      table, cp, available_now=True)
    q.awaitTermination()
    n = msgs.count()
    assert read_table(spark, table).count() == 2 * n
    compact_all(spark, table)
    # the newest batch may be replayed: it stays; the others are folded in
    left = [path_exists(spark, f"{table}/_ingest/ingest_batch_id={q.id}_{b}") for b in range(3)]
    assert left == [False, False, True]
    t = read_table(spark, table)
    assert t.count() == 2 * n and t.groupBy("message_id").count().where("count <> 2").count() == 0
    assert file_counts(spark, table).agg(F.max("files")).first()[0] <= 2


def test_folding_again_after_a_lost_driver_adds_nothing(spark, sf_small, monkeypatch):
    from lakeferry.operators import compact

    table, cp = scratch_path(spark, "table"), scratch_path(spark, "cp")
    write = _writer(table, cp)
    for b in range(3):
        write(_rows_of(spark, [f"{b}-{i}" for i in range(10)]), b)
    with monkeypatch.context() as m:
        m.setattr(compact, "_drop_folded", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError, match="died"):
            compact.compact_all(spark, table)
    compact.compact_all(spark, table)
    t = read_table(spark, table)
    assert t.count() == 30 and t.select("message_id").distinct().count() == 30


def test_progress_of_every_batch(spark, sf_small):
    from lakeferry.streaming.ingest import ProgressLog

    topic, table, cp = (scratch_path(spark, n) for n in ("topic", "table", "cp"))
    msgs = messages_from_events(spark.read.parquet(f"{sf_small}/events.parquet"))
    publish(encode_messages(msgs).repartition(5), "key", "value", "m", path=topic)
    log = ProgressLog(spark, scratch_path(spark, "progress"), every=2)
    spark.streams.addListener(log)
    try:
        q = append_stream(message_stream(read_topic_stream(spark, path=topic, max_per_trigger=1)),
                          table, cp, available_now=True)
        q.awaitTermination()
        rows = log.rows(q).where("num_input_rows > 0")
    finally:
        spark.streams.removeListener(log)
    assert rows.count() == 5 and rows.select("batch_id").distinct().count() == 5
    assert rows.agg(F.sum("num_input_rows")).first()[0] == msgs.count()


def test_kafka_needs_its_jar(spark):
    with pytest.raises((RuntimeError, ValueError)):
        read_topic_stream(spark, topic="messages", brokers="localhost:9092")


def test_processing_time_is_one_value_per_micro_batch(spark, sf_small):
    topic, table, cp = (scratch_path(spark, n) for n in ("topic", "table", "cp"))
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    publish(encode_messages(messages_from_events(events)), "key", "value", "m", path=topic)
    _run(spark, topic, table, cp)
    assert read_table(spark, table).select("processing_time").distinct().count() == 1
    extra = literal_messages(spark, [("click", "2024-01-31", "late", 1)])
    publish(encode_messages(extra), "key", "value", "m", path=topic)
    _run(spark, topic, table, cp)
    assert read_table(spark, table).select("processing_time").distinct().count() == 2


def test_offline_topic_record_shape(spark, sf_small):
    from lakeferry.schema import TOPIC_RECORD
    from lakeferry.sources.topic import read_topic_batch

    topic = scratch_path(spark, "topic")
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    publish(encode_messages(messages_from_events(events)).repartition(4), "key", "value", "t",
            path=topic, num_partitions=3)
    rec = read_topic_batch(spark, path=topic)
    assert rec.schema == TOPIC_RECORD
    n = events.count()
    assert rec.select("offset").distinct().count() == n
    assert {r[0] for r in rec.select("partition").distinct().collect()} <= {0, 1, 2}
    assert rec.where(F.col("key") != F.col("value")).count() == n
    assert rec.where("topic <> 't' OR timestamp IS NULL").count() == 0


def test_tombstone_is_kept_with_null_keys(spark):
    topic, table, cp = (scratch_path(spark, n) for n in ("topic", "table", "cp"))
    good = encode_messages(literal_messages(spark, [("a", "2024-01-01", "1", 1)]))
    tomb = spark.createDataFrame([(bytearray(b"k"), None)], "key binary, value binary")
    publish(good.unionByName(tomb), "key", "value", "m", path=topic)
    _run(spark, topic, table, cp)
    rows = read_table(spark, table).collect()
    assert len(rows) == 2
    nulls = [r for r in rows if r.message_id is None]
    assert len(nulls) == 1 and nulls[0].partition_message_type is None
    assert nulls[0].processing_time is not None
