"""Streaming ingest: topic -> decode -> stamp -> keys -> append to the partitioned table.

Stateless and map-only up to the sink; no watermark or state is needed because rows are
only appended, each to the partition of its own (type, date) — a late row for an old date
simply lands in that old partition.

Sinks
* Delta: Spark's Delta streaming sink (exactly-once through the checkpoint and the log).
* Parquet fallback: ``foreachBatch``. Spark's Parquet *file-stream* sink is not used on
  purpose: its ``_spark_metadata`` log would go stale after compaction. A batch is written
  by one Spark overwrite of its own folder, ``ingest_batch_id=<query>_<batch>``; the query's
  id lives in the checkpoint, so a replay after a restart replaces exactly that batch,
  wherever the job died, and a query that starts over on a new checkpoint replaces nothing.
  Compaction folds batches into the table's partitions.
"""

from __future__ import annotations

import hashlib
import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from lakeferry.operators.messages import decode_messages, enrich
from lakeferry.schema import PARTITION_KEYS
from lakeferry.sources.table import batch_folder, write_table


def message_stream(records: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Topic records (stream or batch) -> rows in stored-table shape."""
    return enrich(decode_messages(records, mode))


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in the checkpoint for the query that runs this batch; outside
    a query (tests) one made from the checkpoint's name."""
    own = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return own or hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:32]


def _parquet_batch_writer(path: str, checkpoint: str, optimize_write: bool):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        folder = batch_folder(path, _query_id(batch.sparkSession, checkpoint), batch_id)
        write_table(batch, folder, "overwrite", "parquet", optimize_write)

    return write_batch


def append_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    available_now: bool = False,
    processing_time: str | None = None,
    optimize_write: bool = True,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start the append query. With neither trigger argument, micro-batches run back to
    back (Spark's default); ``available_now`` drains what is there and stops;
    ``processing_time`` (such as ``"30 seconds"``) starts one at each interval."""
    w = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    if fmt == "delta":
        return w.format("delta").partitionBy(*PARTITION_KEYS).start(path)
    if fmt != "parquet":
        raise ValueError("fmt must be 'delta' or 'parquet'")
    return w.foreachBatch(_parquet_batch_writer(path, checkpoint, optimize_write)).start()


# The progress fields reported per micro-batch.
PROGRESS_SCHEMA = (
    "query_id string, run_id string, batch_id long, timestamp string, num_input_rows long, "
    "input_rows_per_second double, processed_rows_per_second double, trigger_ms long"
)


class ProgressLog(StreamingQueryListener):
    """Every micro-batch's progress as rows, however long a query runs.

    Add it with ``spark.streams.addListener``. Rows are appended to the Parquet folder
    ``path``, ``every`` of them at a time and when a query ends, so nothing grows in the
    driver. :meth:`rows` waits for the queries that have ended to be written.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path, every
        self._held: list[tuple] = []
        self._lock = threading.Condition()
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        row = (p["id"], p["runId"], int(p["batchId"]), p["timestamp"],
               int(p.get("numInputRows") or 0), float(p.get("inputRowsPerSecond") or 0.0),
               float(p.get("processedRowsPerSecond") or 0.0),
               int(p.get("durationMs", {}).get("triggerExecution") or 0))
        with self._lock:
            self._held.append(row)
            if len(self._held) >= self.every:
                self._flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._flush()
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def _flush(self) -> None:
        held, self._held = self._held, []
        if held:
            self.spark.createDataFrame(held, PROGRESS_SCHEMA).coalesce(1).write.mode(
                "append").parquet(self.path)

    def rows(self, *ended: StreamingQuery, timeout: float = 60.0) -> DataFrame:
        """All progress so far; of the queries in ``ended`` (which have stopped) all there
        will be."""
        runs = {str(q.runId) for q in ended}
        with self._lock:
            if not self._lock.wait_for(lambda: runs <= self._ended, timeout):
                raise TimeoutError("the end of a query was not reported")
            self._flush()
        return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.path)
