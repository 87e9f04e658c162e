"""Physical-plan properties the library relies on at scale (checked on the executed plan)."""

from pyspark.sql import functions as F

from lakeferry.operators.messages import decode_messages, encode_messages
from lakeferry.operators.stats import (
    count_by_type,
    partition_row_counts,
    recent_partitions,
    total_rows,
)
from lakeferry.plans.catalog import _messages, q_expired_files, small_file_table
from lakeferry.schema import PARTITION_KEYS
from lakeferry.sources.table import read_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_statistics_read_no_data_columns(spark, sf_small):
    t = read_table(spark, small_file_table(spark, sf_small))
    for df in (partition_row_counts(t), total_rows(t)):
        p = plan(df)
        assert "ReadSchema: struct<>" in p, p
        assert "partial_count" in p  # partial aggregate before the exchange


def test_date_window_is_a_partition_filter(spark, sf_small):
    t = read_table(spark, small_file_table(spark, sf_small))
    p = plan(recent_partitions(t, 7, "2024-01-30"))
    assert "PartitionFilters: [isnotnull(partition_date" in p and "2024-01-23" in p, p


def test_type_counts_prune_other_types(spark, sf_small):
    t = read_table(spark, small_file_table(spark, sf_small))
    p = plan(count_by_type(t, {"click_rows": "click"}))
    assert "PartitionFilters: [isnotnull(partition_message_type" in p, p


def test_compaction_rewrite_is_pruned_and_dealt_by_place(spark, sf_small):
    from lakeferry.operators.compact import _pieces, _settled_rows

    keys = [("click", "2024-01-30", 2), (None, None, 1)]
    path = small_file_table(spark, sf_small)
    rows = _settled_rows(spark, path, keys, [])
    p = plan(_pieces(rows, keys))
    assert "PartitionFilters: [struct(partition_message_type" in p, p
    assert p.count("Exchange hashpartitioning(") == 1 and "piece" in p, p
    assert "row_index" in p and "xxhash64" in p


def test_footer_counts_are_pushed_into_the_scan(spark, sf_small):
    from lakeferry.session import conf_scope
    from lakeferry.sources.table import _FOOTERS, footer_row_counts, scans

    path = small_file_table(spark, sf_small)
    with conf_scope(spark, _FOOTERS):
        total = scans(spark, path)[0].agg(F.count(F.lit(1)))
        text = total._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedAggregation: [COUNT(*)]" in text, text
    want = {tuple(r) for r in partition_row_counts(read_table(spark, path)).collect()}
    assert {tuple(r) for r in footer_row_counts(spark, path).collect()} == want


def test_catalog_table_prunes_by_partition_names(spark, sf_small):
    from lakeferry.sources.table import register_table

    register_table(spark, small_file_table(spark, sf_small), "plan_messages")
    p = plan(spark.sql("SELECT count(*) FROM plan_messages WHERE partition_date = '2024-01-30'"))
    assert "plan_messages_folded" in p and "InMemoryFileIndex(5 paths)" in p, p


def test_no_static_broadcast(spark, sf_small):
    p = plan(q_expired_files(spark, sf_small))
    assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p, p


def test_decode_is_one_arrow_batch_udf(spark, sf_small):
    p = plan(decode_messages(encode_messages(_messages(spark, sf_small))))
    assert p.count("ArrowEvalPython") == 1, p
    assert "BatchEvalPython" not in p  # never the row-at-a-time path


def test_event_mapping_stays_in_codegen(spark, sf_small):
    p = plan(_messages(spark, sf_small).where(F.col("creation_time") > 0))
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p
    assert "*(" in p  # whole-stage codegen span


def test_small_batch_write_is_parallel_with_one_file_per_key(spark):
    """A micro-batch-sized write is not coalesced into one task: several tasks write,
    and each (type, date) partition still gets exactly one file."""
    import collections

    from lakeferry.operators.messages import enrich
    from lakeferry.session import scratch_path
    from lakeferry.sources.table import list_data_files, write_table

    path = scratch_path(spark, "parallel")
    write_table(enrich(_messages(spark, "/root/testdata/sf0.01")), path, mode="overwrite")
    files = list_data_files(spark, path).select("path", *PARTITION_KEYS).collect()
    per_key = collections.Counter((r[1], r[2]) for r in files)
    assert set(per_key.values()) == {1}, per_key
    writers = {r[0].rsplit("/", 1)[1].split("-")[1] for r in files}  # part-<task>-…
    assert len(writers) > 1, writers
