"""Command line for the two jobs.

    python -m lakeferry ingest [--available-now] [--topic-path P] [--max-per-trigger N]
                               [--processing-time "30 seconds"] [--delta]
    python -m lakeferry maintain [--table-path P] [--days N] [--partitions "p1;p2"]
                                 [--no-vacuum] [--retention-hours H] [--no-stats]
                                 [--whole-table] [--per-partition] [--as-of YYYY-MM-DD]
                                 [--budget-bytes B] [--delta]

Flags override the environment, which overrides Spark settings (see ``lakeferry.plans.params``). Partition predicates are
separated by ';' so that a predicate may hold commas (an IN list). Any error ends the
process with a non-zero status after the session is stopped.
"""

from __future__ import annotations

import argparse
import logging
import sys

from lakeferry.plans.jobs import run_maintenance, start_ingest
from lakeferry.plans.params import IngestParams, MaintainParams, session_settings
from lakeferry.session import build_session

log = logging.getLogger("lakeferry")


def _ingest(args) -> None:
    over = {"topic_path": args.topic_path} if args.topic_path else {}
    if args.max_per_trigger:
        over["max_per_trigger"] = args.max_per_trigger
    if args.processing_time:
        over["processing_time"] = args.processing_time
    spark = build_session("lakeferry-ingest", delta=args.delta)
    try:
        params = IngestParams.from_env(conf=session_settings(spark), **over)
        q = start_ingest(spark, params, available_now=args.available_now,
                         fmt="delta" if args.delta else None)
        q.awaitTermination()
    finally:
        spark.stop()


def _maintain(args) -> None:
    over = {}
    if args.table_path:
        over["table_path"] = args.table_path
    if args.days is not None:
        over["days_to_compact"] = args.days
    if args.partitions:
        preds = [p.strip() for p in args.partitions.split(";")]
        over["specific_partitions"] = tuple(p for p in preds if p)
    if args.no_vacuum:
        over["vacuum"] = False
    if args.retention_hours is not None:
        over["vacuum_retention_hours"] = args.retention_hours
    if args.no_stats:
        over["generate_statistics"] = False
    if args.whole_table:
        over["compact_by_partition"] = False
    if args.allow_short_retention:
        over["allow_short_retention"] = True
    if args.per_partition:
        over["per_partition"] = True
    if args.as_of:
        over["as_of"] = args.as_of
    if args.budget_bytes is not None:
        over["compact_budget_bytes"] = args.budget_bytes
    spark = build_session("lakeferry-maintain", delta=args.delta)
    try:
        params = MaintainParams.from_env(conf=session_settings(spark), **over)
        res = run_maintenance(spark, params)
        for r in res.steps.collect():
            log.info("%s: %s (%s)", r.step, r.status, r.detail)
        if res.partition_counts is not None:
            log.info("total rows: %s", res.total_rows)
            if args.stats_path:
                res.partition_counts.write.mode("overwrite").parquet(args.stats_path)
            else:
                for r in res.partition_counts.toLocalIterator():
                    log.info("%s", r.asDict())
    finally:
        spark.stop()


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    ap = argparse.ArgumentParser(prog="lakeferry")
    sub = ap.add_subparsers(dest="job", required=True)
    ing = sub.add_parser("ingest", help="topic -> partitioned table (streaming)")
    ing.add_argument("--available-now", action="store_true", help="drain and stop")
    ing.add_argument("--topic-path", help="offline topic directory instead of Kafka")
    ing.add_argument("--max-per-trigger", type=int,
                     help="records (Kafka) or files (offline topic) per micro-batch")
    ing.add_argument("--processing-time", help="interval between micro-batches")
    ing.add_argument("--delta", action="store_true")
    m = sub.add_parser("maintain", help="compact, vacuum, statistics")
    m.add_argument("--table-path")
    m.add_argument("--days", type=int)
    m.add_argument("--partitions", help="predicates separated by ';'")
    m.add_argument("--no-vacuum", action="store_true")
    m.add_argument("--retention-hours", type=int)
    m.add_argument("--allow-short-retention", action="store_true",
                   help="accept a retention under 168 hours")
    m.add_argument("--no-stats", action="store_true")
    m.add_argument("--stats-path", help="write the partition counts there instead of logging them")
    m.add_argument("--whole-table", action="store_true")
    m.add_argument("--per-partition", action="store_true")
    m.add_argument("--as-of")
    m.add_argument("--budget-bytes", type=int, help="bytes one compaction may rewrite")
    m.add_argument("--delta", action="store_true")
    args = ap.parse_args(argv)
    try:
        (_ingest if args.job == "ingest" else _maintain)(args)
    except Exception:
        log.exception("%s job failed", args.job)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
