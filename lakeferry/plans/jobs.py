"""The two jobs (ingest, maintenance) and the embeddable compaction entry point."""

from __future__ import annotations

import dataclasses
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeferry.operators.compact import (
    STATUS_SCHEMA,
    choose_targets,
    compact_all,
    compact_partitions,
    compact_recent,
    error_text,
)
from lakeferry.operators.stats import partition_row_counts
from lakeferry.operators.vacuum import vacuum
from lakeferry.plans.params import IngestParams, MaintainParams, session_settings
from lakeferry.session import (
    build_session,
    checkpoint_root,
    configure_object_store,
    delta_session,
    object_store_conf,
)
from lakeferry.sources.table import read_table, table_format
from lakeferry.sources.topic import read_topic_stream
from lakeferry.streaming.ingest import append_stream, message_stream

log = logging.getLogger("lakeferry")

STEP_SCHEMA = "step string, status string, detail string"


def _object_store(spark: SparkSession, p) -> None:
    if p.s3_endpoint:
        configure_object_store(
            spark, object_store_conf(p.s3_endpoint, p.s3_access_key, p.s3_secret_key,
                                     p.s3_path_style, p.s3_ssl)
        )


def start_ingest(
    spark: SparkSession, params: IngestParams, available_now: bool = False, fmt: str | None = None
) -> StreamingQuery:
    """Build and start the ingest query (topic -> table)."""
    _object_store(spark, params)
    records = read_topic_stream(
        spark,
        topic=params.topic,
        brokers=params.brokers,
        path=params.topic_path,
        starting_offsets=params.starting_offsets,
        fail_on_data_loss=params.fail_on_data_loss,
        max_per_trigger=params.max_per_trigger,
    )
    fmt = fmt or table_format(spark, params.table_path) or (
        "delta" if delta_session(spark) else "parquet")
    return append_stream(
        message_stream(records, params.decode_mode),
        params.table_path,
        params.checkpoint,
        fmt=fmt,
        available_now=available_now,
        processing_time=params.processing_time,
    )


def run_ingest(params: IngestParams | None = None, delta: bool = False) -> None:
    """Process entry point: start, block until the query ends, always stop the session.
    A failed query re-raises its error."""
    spark = build_session("lakeferry-ingest", delta=delta)
    try:
        params = params or IngestParams.from_env(conf=session_settings(spark))
        q = start_ingest(spark, params, fmt="delta" if delta else None)
        log.info("ingest started: %s", params)
        q.awaitTermination()
    finally:
        spark.stop()


@dataclasses.dataclass
class MaintenanceResult:
    steps: DataFrame
    total_rows: int | None = None
    partition_counts: DataFrame | None = None


def _compact(spark: SparkSession, p: MaintainParams) -> DataFrame:
    path, budget = p.table_path, p.compact_budget_bytes
    if not p.compact_by_partition:
        return compact_all(spark, path, budget_bytes=budget)
    if p.specific_partitions:
        return compact_partitions(spark, path, list(p.specific_partitions),
                                  per_partition=p.per_partition, budget_bytes=budget)
    if p.per_partition:
        preds = choose_targets(spark, path, None, p.days_to_compact, p.as_of)
        return compact_partitions(spark, path, preds, per_partition=True)
    return compact_recent(spark, path, p.days_to_compact, p.as_of, budget_bytes=budget)


def compact_table(
    spark: SparkSession, path: str, params: MaintainParams | None = None
) -> DataFrame:
    """Embeddable compaction: guard then compact (no vacuum, no statistics). A missing
    table gives one ``no_table`` status row instead of an error."""
    params = dataclasses.replace(params or MaintainParams(), table_path=path)
    _object_store(spark, params)
    if table_format(spark, path) is None:
        log.warning("no table at %s; skipping compaction", path)
        return spark.createDataFrame([(path, "no_table", None, None, None)], STATUS_SCHEMA)
    return _compact(spark, params)


def run_maintenance(spark: SparkSession, params: MaintainParams | None = None) -> MaintenanceResult:
    """guard -> compact -> [vacuum] -> [statistics]; one status row per step.

    A failure is reported with its whole message and the job goes on.
    """
    p = params or MaintainParams.from_env(conf=session_settings(spark))
    _object_store(spark, p)
    path = p.table_path
    if table_format(spark, path) is None:
        log.warning("no table at %s; nothing to maintain", path)
        return MaintenanceResult(spark.createDataFrame([("guard", "no_table", path)], STEP_SCHEMA))
    steps = [("guard", "ok", path)]
    try:
        targets = _compact(spark, p).collect()  # a row for each predicate given
        failed = sum(t.status == "failed" for t in targets)
        done = [t for t in targets if t.status == "compacted"]
        text = f"{failed} failed targets"
        if any(t.partitions is not None for t in done):  # Delta does not tell
            text += ", {} partitions, {} rows".format(*(
                sum(t[k] or 0 for t in done) for k in ("partitions", "rows")))
        steps.append(("compact", "ok" if failed == 0 else "partial", text))
        steps += [("compact", t.status, t.error) for t in targets if t.status == "deferred"]
    except Exception as e:
        log.error("compaction failed: %s", e)
        steps.append(("compact", "failed", error_text(e)))
    if p.vacuum:
        try:
            removed = vacuum(spark, path, p.vacuum_retention_hours,
                             allow_short_retention=p.allow_short_retention).count()
            steps.append(("vacuum", "ok", f"{removed} removed"))
        except Exception as e:
            log.error("vacuum failed: %s", e)
            steps.append(("vacuum", "failed", error_text(e)))
    total, counts = None, None
    if p.generate_statistics:
        try:
            table = read_table(spark, path)
            checkpoint_root(spark)
            counts = partition_row_counts(table).checkpoint()  # one pass over the footers
            total = counts.agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]
            steps.append(("statistics", "ok", f"{total} rows"))
        except Exception as e:
            log.error("statistics failed: %s", e)
            steps.append(("statistics", "failed", error_text(e)))
    return MaintenanceResult(spark.createDataFrame(steps, STEP_SCHEMA), total, counts)


def history(spark: SparkSession, path: str) -> DataFrame:
    """Commit history of a Delta table (needs Delta; a Parquet layout keeps none)."""
    if table_format(spark, path) != "delta":
        raise NotImplementedError("table history needs a Delta table")
    jdf = spark._jvm.io.delta.tables.DeltaTable.forPath(spark._jsparkSession, path).history()
    return DataFrame(jdf, spark)
