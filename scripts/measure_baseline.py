"""

usage: python scripts/measure_baseline.py [sf_dir] [cpus]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from lakeferry.operators.compact import compact_recent, file_counts  # noqa: E402
from lakeferry.operators.messages import decode_messages, encode_messages  # noqa: E402
from lakeferry.operators.stats import partition_row_counts  # noqa: E402
from lakeferry.plans import catalog as C  # noqa: E402
from lakeferry.session import build_session, scratch_path  # noqa: E402
from lakeferry.sources.table import read_table  # noqa: E402
from lakeferry.sources.topic import publish, read_topic_batch, read_topic_stream  # noqa: E402
from lakeferry.streaming.ingest import append_stream, message_stream  # noqa: E402


def timed(fn, runs=5):
    fn()
    out = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        out.append(time.perf_counter() - t0)
    return statistics.median(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    spark = build_session(
        "lakeferry-baseline",
        master=f"local[{cpus}]",
        conf={
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": "4g",  # as bench.py
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    n = spark.read.parquet(f"{sf}/events.parquet").count()
    topic = scratch_path(spark, "topic")
    publish(encode_messages(C._messages(spark, sf)).repartition(cpus), "key", "value", "m",
            path=topic)
    res = {"sf_dir": sf, "cpus": cpus, "rows": n}

    t = timed(lambda: decode_messages(read_topic_batch(spark, path=topic))
              .write.format("noop").mode("overwrite").save())
    res["avro_decode_rows_per_s"] = round(n / t)
    t = timed(lambda: encode_messages(C._messages(spark, sf))
              .write.format("noop").mode("overwrite").save())
    res["avro_encode_rows_per_s"] = round(n / t)

    def catch_up():
        q = append_stream(message_stream(read_topic_stream(spark, path=topic)),
                          scratch_path(spark, "t"), scratch_path(spark, "cp"), available_now=True)
        q.awaitTermination()
    t = timed(catch_up)
    res["stream_catch_up_rows_per_s"] = round(n / t)

    table = C.stored_table(spark, sf)
    res["partition_row_counts_s"] = round(timed(lambda: partition_row_counts(table).collect()), 3)

    times, before, after = [], [], []
    for _ in range(5):
        path = C.small_file_table(spark, sf)
        window = F.col("partition_date").between("2024-01-23", "2024-01-30")
        before.append(file_counts(spark, path).where(window).agg(F.sum("files")).first()[0])
        t0 = time.perf_counter()
        compact_recent(spark, path, 7, "2024-01-30")
        times.append(time.perf_counter() - t0)
        after.append(file_counts(spark, path).where(window).agg(F.sum("files")).first()[0])
        assert read_table(spark, path).count() == n
    res["compact_recent_s"] = round(statistics.median(times), 3)
    res["compact_recent_files_before_after"] = [before[0], after[0]]
    print(json.dumps(res))
    spark.stop()


if __name__ == "__main__":
    main()
