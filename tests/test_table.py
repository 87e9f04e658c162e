"""Table layout: the reader keeps partition keys as strings; overwrite scopes."""

from pyspark.sql import types as T

from lakeferry.operators.messages import enrich
from lakeferry.session import scratch_path
from lakeferry.sources.synth import literal_messages
from lakeferry.sources.table import is_table, read_table, table_format, write_table


def test_partition_keys_stay_strings(spark):
    path = scratch_path(spark, "t")
    write_table(enrich(literal_messages(spark, [("a", "2024-01-15", "1", 1)])), path, "overwrite")
    inferred = spark.read.parquet(path)
    assert isinstance(inferred.schema["partition_date"].dataType, T.DateType)
    ours = read_table(spark, path)
    assert isinstance(ours.schema["partition_date"].dataType, T.StringType)
    assert ours.first().partition_date == "2024-01-15"
    assert table_format(spark, path) == "parquet" and is_table(spark, path)
    assert not is_table(spark, scratch_path(spark, "nothing"))


def test_overwrite_scopes(spark):
    path = scratch_path(spark, "t")
    rows = [("a", "2024-01-15", "1", 1), ("b", "2024-01-16", "2", 2)]
    write_table(enrich(literal_messages(spark, rows)), path, "overwrite")
    write_table(enrich(literal_messages(spark, [("a", "2024-01-15", "3", 3)])), path, "overwrite",
                replace="partitions")
    assert sorted(r.message_id for r in read_table(spark, path).collect()) == ["2", "3"]
    write_table(enrich(literal_messages(spark, [("c", "2024-01-17", "4", 4)])), path, "overwrite")
    assert [r.message_id for r in read_table(spark, path).collect()] == ["4"]


def test_sql_over_registered_view(spark):
    from lakeferry.sources.table import register_view

    path = scratch_path(spark, "t")
    rows = [("a", "2024-01-15", "1", 1), ("a", "2024-01-15", "2", 2), ("b", "2024-01-16", "3", 3)]
    write_table(enrich(literal_messages(spark, rows)), path, "overwrite")
    register_view(spark, path, "msgs_view")
    got = spark.sql(
        "SELECT partition_message_type, partition_date, COUNT(*) AS row_count FROM msgs_view "
        "GROUP BY partition_message_type, partition_date "
        "ORDER BY partition_date DESC, partition_message_type").collect()
    assert [tuple(r) for r in got] == [("b", "2024-01-16", 1), ("a", "2024-01-15", 2)]


def test_listing_decodes_escaped_partition_values(spark):
    from lakeferry.operators.compact import file_counts

    path = scratch_path(spark, "t")
    odd = "we ird/ty=pe+%:x"
    write_table(enrich(literal_messages(spark, [(odd, "2024-01-15", "1", 1)])), path, "overwrite")
    keys = {(r.partition_message_type, r.partition_date) for r in file_counts(spark, path).collect()}
    assert keys == {(odd, "2024-01-15")}
    assert read_table(spark, path).first().partition_message_type == odd


def test_delta_log_without_delta_is_an_error(spark):
    import os

    import pytest

    path = scratch_path(spark, "d")
    local = path.removeprefix("file:")
    os.makedirs(os.path.join(local, "_delta_log"))
    with pytest.raises(RuntimeError, match="Delta"):
        table_format(spark, path)
