"""Run in its own process (task retries need a fresh local[N, maxFailures] context): the
first attempt of one task fails inside each write; the retried job must keep every row
exactly once. Prints one line per check and exits non-zero on a mismatch."""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from lakeferry.operators.compact import compact_all  # noqa: E402
from lakeferry.operators.messages import enrich, encode_messages  # noqa: E402
from lakeferry.session import build_session, scratch_path  # noqa: E402
from lakeferry.sources.synth import messages_from_events  # noqa: E402
from lakeferry.sources.table import read_table, write_table  # noqa: E402
from lakeferry.sources.topic import publish, read_topic_stream  # noqa: E402
from lakeferry.streaming.ingest import append_stream, message_stream  # noqa: E402


MARKS = tempfile.mkdtemp(prefix="lakeferry-faults-")  # local test: tasks share the disk


def _fail_first_attempt(v):
    """Identity, except that the first attempt of partition 0 fails (a lost task); each
    injected failure leaves a marker so the check can see it really happened."""
    tc = TaskContext.get()
    if tc.partitionId() == 0 and tc.attemptNumber() == 0:
        open(os.path.join(MARKS, f"stage-{tc.stageId()}"), "w").close()
        raise RuntimeError("injected task failure")
    return v


def check(name, df, expected, marks_before):
    """Rows kept exactly once; with ``marks_before`` also that a failure was injected."""
    failures = 0 if marks_before is None else len(os.listdir(MARKS)) - marks_before
    n = df.count()
    ids = df.select("message_id").distinct().count()
    ok = n == expected == ids and (marks_before is None or failures >= 1)
    print(f"{name}: injected_failures={failures} rows={n} distinct_ids={ids} "
          f"expected={expected} {'OK' if ok else 'BAD'}")
    return ok


def main():
    sf_dir = sys.argv[1]
    spark = build_session("lakeferry-faults", master="local[4,4]",
                          conf={"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("OFF")
    fail_first_attempt = F.pandas_udf(_fail_first_attempt, "long")
    msgs = messages_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    n = msgs.count()
    flaky = enrich(msgs).withColumn("creation_time", fail_first_attempt("creation_time"))
    good = True

    # 1. a table write whose writer task fails once (no shuffle before the writer)
    path = scratch_path(spark, "faults-write")
    marks = len(os.listdir(MARKS))
    write_table(flaky.repartition(4), path, optimize_write=False)
    good &= check("write", read_table(spark, path), n, marks)

    # 2. a stream micro-batch whose decode task fails once, before the rebalanced write
    topic, table, ckpt = (scratch_path(spark, x) for x in ("ft", "fs", "fc"))
    publish(encode_messages(msgs).repartition(4), "key", "value", topic="m", path=topic)
    rows = message_stream(read_topic_stream(spark, path=topic)).withColumn(
        "creation_time", fail_first_attempt("creation_time"))
    marks = len(os.listdir(MARKS))
    append_stream(rows, table, ckpt, available_now=True).awaitTermination()
    good &= check("stream", read_table(spark, table), n, marks)

    # 3. compaction of the table the failing write left (no Python step to fail here):
    # rows kept, none doubled, so no attempt file of the failed task was committed
    compact_all(spark, path)
    good &= check("compact", read_table(spark, path), n, None)
    spark.stop()
    sys.exit(0 if good else 1)


if __name__ == "__main__":
    main()
