"""Compaction, targets, vacuum, statistics and the maintenance job."""

import os
import time

import pytest
from pyspark.sql import functions as F

from lakeferry.operators.compact import (
    choose_targets,
    compact_all,
    compact_partitions,
    compact_recent,
    file_counts,
)
from lakeferry.operators.stats import (
    date_window,
    partition_row_counts,
    recent_partitions,
    total_row_count,
    validate_predicates,
)
from lakeferry.operators.vacuum import expired_files, vacuum
from lakeferry.plans.catalog import small_file_table
from lakeferry.plans.jobs import compact_table, run_maintenance
from lakeferry.plans.params import MaintainParams
from lakeferry.schema import MESSAGE_TABLE
from lakeferry.session import scratch_path
from lakeferry.sources.table import read_table, write_table

COLS = [f.name for f in MESSAGE_TABLE.fields if f.name != "processing_time"]


def _files(spark, path):
    return {(r[0], r[1]): r[2] for r in file_counts(spark, path).collect()}


def _rows(spark, path):
    return read_table(spark, path).select(*COLS)


def test_window_covers_days_plus_one():
    assert date_window(7, "2024-01-30") == ("2024-01-23", "2024-01-30")
    assert date_window(0, "2024-03-01") == ("2024-03-01", "2024-03-01")


def test_recent_partitions(spark, sf_small):
    path = small_file_table(spark, sf_small)
    got = [r[0] for r in recent_partitions(read_table(spark, path), 7, "2024-01-30").collect()]
    assert got == [f"2024-01-{d:02d}" for d in range(30, 22, -1)]
    assert choose_targets(spark, path, None, 1, "2024-01-30") == [
        "partition_date = '2024-01-30'", "partition_date = '2024-01-29'"]
    assert choose_targets(spark, path, ["partition_date = 'x'"]) == ["partition_date = 'x'"]


def test_compact_recent_keeps_rows_and_cuts_files(spark, sf_small):
    path = small_file_table(spark, sf_small)
    before_rows = _rows(spark, path).checkpoint()
    before = _files(spark, path)
    compact_recent(spark, path, 7, "2024-01-30")
    after = _files(spark, path)
    now = _rows(spark, path)
    assert now.exceptAll(before_rows).count() == 0 and before_rows.exceptAll(now).count() == 0
    for (t, d), n in before.items():
        if "2024-01-23" <= d <= "2024-01-30":
            assert after[(t, d)] == 1 <= n
        else:
            assert after[(t, d)] == n  # untouched partitions keep their files
    assert sum(after.values()) < sum(before.values())
    compact_recent(spark, path, 7, "2024-01-30")  # second run: same content
    assert _files(spark, path) == after and _rows(spark, path).count() == before_rows.count()


def test_compact_specific_isolates_failures(spark, sf_small):
    path = small_file_table(spark, sf_small)
    n = _rows(spark, path).count()
    status = compact_partitions(
        spark, path,
        ["partition_date = '2024-01-05'", "no_such_column = 1",
         "partition_message_type = 'click' AND partition_date >= '2024-01-20'"],
        per_partition=True,
    )
    st = {r.target: r.status for r in status.collect()}
    assert st["no_such_column = 1"] == "failed"
    assert list(st.values()).count("compacted") == 2
    files = _files(spark, path)
    assert all(v == 1 for (t, d), v in files.items() if d == "2024-01-05")
    assert _rows(spark, path).count() == n


def test_single_pass_specific_and_full(spark, sf_small):
    path = small_file_table(spark, sf_small)
    n = _rows(spark, path).count()
    compact_partitions(spark, path, ["partition_date IN ('2024-01-02', '2024-01-03')"])
    files = _files(spark, path)
    assert all(v == 1 for (t, d), v in files.items() if d in ("2024-01-02", "2024-01-03"))
    compact_all(spark, path)
    assert set(_files(spark, path).values()) == {1}
    assert total_row_count(read_table(spark, path)) == n


def test_validate_predicates(spark):
    assert validate_predicates(spark, [" partition_date = '2024-01-15' ", ""]) == [
        "partition_date = '2024-01-15'"]
    with pytest.raises(Exception):
        validate_predicates(spark, ["date = '2024-01-15'"])


def test_missing_table(spark):
    missing = scratch_path(spark, "missing")
    res = run_maintenance(spark, MaintainParams(table_path=missing))
    assert [tuple(r)[:2] for r in res.steps.collect()] == [("guard", "no_table")]
    assert [r.status for r in compact_table(spark, missing).collect()] == ["no_table"]


def test_maintenance_job(spark, sf_small):
    path = small_file_table(spark, sf_small)
    res = run_maintenance(spark, MaintainParams(table_path=path, as_of="2024-01-30"))
    steps = {r.step: r.status for r in res.steps.collect()}
    assert steps == {"guard": "ok", "compact": "ok", "vacuum": "ok", "statistics": "ok"}
    assert res.total_rows == 1000
    assert res.partition_counts.count() == 150


def test_expired_files(spark):
    listing = spark.createDataFrame(
        [("a", 10), ("b", 20), ("c", 30), ("d", 5)], "path string, modified_ms long")
    live = spark.createDataFrame([("a",), ("c",)], "path string")
    got = sorted(r.path for r in expired_files(listing, live, 25).collect())
    assert got == ["b", "d"]


def test_vacuum_parquet_leftovers(spark, sf_small):
    path = small_file_table(spark, sf_small)
    local = path.removeprefix("file:")
    old = os.path.join(local, "_temporary")
    new = os.path.join(local, ".spark-staging-recent")
    os.makedirs(os.path.join(old, "0"))
    os.makedirs(new)
    past = time.time() - 200 * 3600
    os.utime(old, (past, past))
    with pytest.raises(ValueError):
        vacuum(spark, path, retention_hours=48)
    assert [r.path.split("/")[-1] for r in vacuum(spark, path, dry_run=True).collect()] == [
        "_temporary"]
    assert os.path.exists(old)
    vacuum(spark, path)
    assert not os.path.exists(old) and os.path.exists(new)
    assert read_table(spark, path).count() == 1000


def test_partition_counts_order(spark, sf_small):
    path = small_file_table(spark, sf_small)
    rows = partition_row_counts(read_table(spark, path)).collect()
    keys = [(r.partition_date, r.partition_message_type) for r in rows]
    assert keys == sorted(keys, key=lambda k: (-int(k[0].replace("-", "")), k[1]))
    assert sum(r.row_count for r in rows) == 1000


def test_hot_key_is_split_not_funnelled(spark):
    """One type holds well over a third of the rows: the rewrite splits it into several
    advisory-size files (several tasks) and keeps every row."""
    from lakeferry.operators.messages import enrich
    from lakeferry.sources.synth import synth_messages
    from lakeferry.sources.table import write_table

    ids = spark.range(60000)
    msgs = synth_messages(ids, "id", seed=1, date="2024-01-10").withColumn(
        "message_type",
        F.when(F.col("creation_time") % 5 < 2, F.lit("hot")).otherwise(F.col("message_type")),
    )
    path = scratch_path(spark, "skew")
    write_table(enrich(msgs).repartition(8), path, optimize_write=False)
    n = read_table(spark, path).count()
    # emulate many input splits (as a large table has) so the hot key has many map blocks
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        compact_all(spark, path, target_file_bytes=64 * 1024)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    files = _files(spark, path)
    assert files[("hot", "2024-01-10")] > 1
    assert read_table(spark, path).count() == n == 60000
    hot = read_table(spark, path).where("partition_message_type = 'hot'").count()
    assert hot >= 60000 // 3


def test_windowed_file_listing(spark, sf_small):
    path = small_file_table(spark, sf_small)
    whole = _files(spark, path)
    dates = ["2024-01-29", "2024-01-30"]
    part = {(r[0], r[1]): r[2] for r in file_counts(spark, path, dates).collect()}
    assert part == {k: v for k, v in whole.items() if k[1] in dates}
    assert file_counts(spark, path, []).count() == 0
    assert file_counts(spark, path, ["1999-01-01"]).count() == 0
    assert file_counts(spark, path, ["1999-01-01", "2024-01-30"]).count() == 5


def _file_paths(spark, path):
    from lakeferry.sources.table import list_data_files

    return {r[0] for r in list_data_files(spark, path).select("path").collect()}


def test_second_compaction_rewrites_nothing(spark, sf_small):
    """Already compacted partitions are left alone (as Delta's OPTIMIZE does): a rerun over
    the same window keeps every file, and only partitions with new small files are
    rewritten."""
    path = small_file_table(spark, sf_small)
    compact_recent(spark, path, 7, "2024-01-30")
    after_first = _file_paths(spark, path)
    compact_recent(spark, path, 7, "2024-01-30")
    assert _file_paths(spark, path) == after_first
    # two more small files into one compacted partition: only that one is rewritten
    one = read_table(spark, path).where(
        "partition_message_type = 'click' AND partition_date = '2024-01-30'"
    )
    from lakeferry.sources.table import write_table

    write_table(one.limit(2).repartition(2), path, mode="append", optimize_write=False)
    added = _file_paths(spark, path) - after_first
    assert len(added) == 2
    n = read_table(spark, path).count()
    compact_recent(spark, path, 7, "2024-01-30")
    now = _file_paths(spark, path)
    changed = {p for p in after_first ^ now if "partition_date=2024-01-30" in p}
    assert (after_first - now) and all(
        "partition_message_type=click/partition_date=2024-01-30" in p for p in after_first ^ now
    ), changed
    assert read_table(spark, path).count() == n


def test_small_file_check_lists_files_only(spark, sf_small):
    """The small-file check reads the listing (no file contents) and the rewrite is pruned
    to the chosen partitions, null (tombstone) partition included."""
    from lakeferry.operators.compact import _key_in, rank_partitions
    from lakeferry.sources.table import list_data_files

    path = small_file_table(spark, sf_small)
    files = list_data_files(spark, path, F.col("partition_date") == "2024-01-30")
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan and "partition_date" in plan.split(
        "PartitionFilters:")[1].split("]")[0], plan
    keys = {tuple(r)[:2] for r in rank_partitions(files, 1 << 20).collect()}
    assert keys
    assert ("click", "2024-01-30") in keys and all(k[1] == "2024-01-30" for k in keys)
    t = read_table(spark, path)
    pick = [("click", "2024-01-30"), (None, None)]
    pruned = t.where(_key_in(pick))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [struct(partition_message_type" in pruned, pruned
    assert t.where(_key_in(pick)).count() == t.where(
        "partition_message_type = 'click' AND partition_date = '2024-01-30'"
    ).count()


def test_tombstone_partition_lists_as_null_and_compacts(spark):
    from lakeferry.operators.messages import enrich
    from lakeferry.sources.synth import literal_messages
    from lakeferry.sources.table import list_data_files, write_table

    path = scratch_path(spark, "tomb")
    rows = [(None, None, None, None), ("click", "2024-01-30", "a", 1)]
    for _ in range(2):  # two small files in each partition
        write_table(enrich(literal_messages(spark, rows)), path, optimize_write=False)
    listing = list_data_files(spark, path).select("partition_message_type", "partition_date")
    assert {tuple(r) for r in listing.collect()} == {(None, None), ("click", "2024-01-30")}
    before = file_counts(spark, path).checkpoint()
    compact_all(spark, path)
    assert _files(spark, path) == {(None, None): 1, ("click", "2024-01-30"): 1}
    from lakeferry.operators.compact import file_report

    counts = read_table(spark, path).groupBy("partition_message_type", "partition_date").count()
    rep = {(r[0], r[1]): (r["files_before"], r["files_after"], r["count"])
           for r in file_report(before, file_counts(spark, path), counts).collect()}
    assert rep == {(None, None): (2, 1, 2), ("click", "2024-01-30"): (2, 1, 2)}
    assert read_table(spark, path).where("partition_date IS NULL").count() == 2


def test_many_partitions_are_several_jobs_of_one_plan(spark, sf_small, monkeypatch):
    """More partitions than one job takes are rewritten by several jobs of the same plan;
    the result is the same: every small-file partition compacted, rows kept."""
    import lakeferry.operators.compact as C

    path = small_file_table(spark, sf_small)
    before = _files(spark, path)
    n = read_table(spark, path).count()
    monkeypatch.setattr(C, "JOB_PARTITIONS", 40)
    done = C._rewrite(spark, path, None, None)
    assert done.partitions == sum(v >= 2 for v in before.values())
    after = _files(spark, path)
    assert after.keys() == before.keys() and set(after.values()) == {1}
    assert read_table(spark, path).count() == n
    assert C._rewrite(spark, path, None, None) == C.Rewritten()  # nothing left to do


def test_per_partition_job_compacts_the_window_only(spark, sf_small):
    """The job's one-target-per-date mode: the window's dates are compacted (listing only
    those date directories), every other date keeps its files, every row is kept."""
    path = small_file_table(spark, sf_small)
    before = _files(spark, path)
    n = read_table(spark, path).count()
    res = run_maintenance(spark, MaintainParams(
        table_path=path, as_of="2024-01-30", days_to_compact=2, per_partition=True,
        vacuum=False, generate_statistics=False))
    assert [r.status for r in res.steps.collect()] == ["ok", "ok"]
    after = _files(spark, path)
    window = {"2024-01-28", "2024-01-29", "2024-01-30"}
    for key, files in after.items():
        if key[1] in window:
            assert files == 1, key
        else:
            assert files == before[key], key
    assert read_table(spark, path).count() == n


def test_overlapping_targets_share_one_listing_and_keep_rows(spark, sf_small):
    """Two per-target predicates over the same partitions: the second works from the
    shared (now stale) listing and rewrites them again, but no row is lost or doubled."""
    path = small_file_table(spark, sf_small)
    rows = _rows(spark, path).checkpoint()
    preds = ["partition_date = '2024-01-30'",
             "partition_date >= '2024-01-29' AND partition_message_type = 'click'"]
    status = compact_partitions(spark, path, preds, per_partition=True)
    assert [r.status for r in status.collect()] == ["compacted", "compacted"]
    assert _rows(spark, path).exceptAll(rows).count() == 0
    assert rows.exceptAll(_rows(spark, path)).count() == 0
    files = _files(spark, path)
    assert all(v == 1 for k, v in files.items() if k[1] == "2024-01-30")
    assert files[("click", "2024-01-29")] == 1


def _append(spark, path, rows, files):
    from lakeferry.operators.messages import enrich

    msgs = spark.createDataFrame(
        rows, "message_type string, date string, message_id string, creation_time long")
    write_table(enrich(msgs).repartition(files), path, optimize_write=False)


def test_every_date_text_of_the_window_is_compacted_and_quotes_stay_text(spark):
    from lakeferry.session import scratch_path

    path = scratch_path(spark, "dates")
    inside = ["2024-01-25", "2024-01-25T10", "2024-01-26 ", "2024-01-2x", "2024-01-25' OR '1'='1"]
    rows = [("t", d, f"{d}{i}", i) for d in [*inside, "2023-01-01"] for i in range(30)]
    _append(spark, path, rows, 3)
    before = _files(spark, path)
    res = run_maintenance(spark, MaintainParams(
        table_path=path, as_of="2024-01-30", days_to_compact=7, per_partition=True, vacuum=False))
    assert [r.status for r in res.steps.collect()] == ["ok", "ok", "ok"]
    after = _files(spark, path)
    assert all(after[("t", d)] == 1 < before[("t", d)] for d in inside)
    assert after[("t", "2023-01-01")] == before[("t", "2023-01-01")]
    assert res.total_rows == 180 and res.partition_counts.count() == 6


def test_second_pass_over_a_split_hot_partition_rewrites_nothing(spark):
    import lakeferry.operators.compact as C
    from lakeferry.session import scratch_path
    from lakeferry.sources.table import list_data_files

    path = scratch_path(spark, "hot")
    _append(spark, path, [("t", "2024-01-30", f"id-{i * 7919 % 100003}", i) for i in range(40_000)], 24)
    target = 120_000
    assert C._rewrite(spark, path, None, target) == C.Rewritten(1, 40_000)
    first = {r.path for r in list_data_files(spark, path).collect()}
    assert 2 <= len(first) < 24
    for _ in range(2):  # fewer bytes may need one file less, once
        n = C._rewrite(spark, path, None, target)
    last = {r.path for r in list_data_files(spark, path).collect()}
    assert n.partitions == 0 == C._rewrite(spark, path, None, target).partitions
    assert {r.path for r in list_data_files(spark, path).collect()} == last
    assert read_table(spark, path).count() == 40_000


def test_a_bad_predicate_fails_alone_with_its_whole_message(spark, sf_small):
    path = small_file_table(spark, sf_small)
    status = {r.target: r for r in compact_partitions(
        spark, path, ["no_such_column = 1", "partition_date = '2024-01-30'"]).collect()}
    assert status["no_such_column = 1"].status == "failed"
    assert "no_such_column" in status["no_such_column = 1"].error
    assert status["partition_date = '2024-01-30'"].status == "compacted"
    assert all(v == 1 for k, v in _files(spark, path).items() if k[1] == "2024-01-30")


def test_vacuum_keeps_a_staging_folder_with_the_only_copy(spark, sf_small):
    import os
    import shutil

    from lakeferry.operators.vacuum import vacuum

    path = small_file_table(spark, sf_small)
    local = path.removeprefix("file:")
    part = "partition_message_type=click/partition_date=2024-01-30"
    for name, keep in ((".spark-staging-only", True), (".spark-staging-old", False)):
        dest = f"{local}/{name}/" + (part if keep else "partition_message_type=view/partition_date=2024-01-29")
        os.makedirs(os.path.dirname(dest))
        source = f"{local}/" + dest.split(name + "/")[1]
        shutil.copytree(source, dest)
    os.rename(f"{local}/{part}", f"{local}/_lost")  # the driver died before the rename
    gone = vacuum(spark, path, now_ms=4_000_000_000_000).collect()
    assert [os.path.basename(r.path) for r in gone] == [".spark-staging-old"]
    assert os.path.isdir(f"{local}/.spark-staging-only") and not os.path.exists(f"{local}/.spark-staging-old")


def _facts(spark, rows):
    return spark.createDataFrame(
        rows, "partition_message_type string, partition_date string, size_bytes long")


def test_partitions_rank_by_files_saved_per_byte(spark):
    from lakeferry.operators.compact import rank_partitions

    mb = 1 << 20
    rows = [("big", "d", 64 * mb)] * 1000 + [("big", "d", 1000)] * 2  # two beside many good ones
    rows += [("small", f"d{i}", 2000 + i) for i in range(6) for _ in range(40)]
    rows += [("fine", "d", 64 * mb), ("fine", "d", 10)]
    rows += [(None, None, 5)] * 3
    got = rank_partitions(_facts(spark, rows), 64 * mb, 500_000).orderBy("bytes_before").collect()
    assert [(r[0], r[1]) for r in got] == [(None, None)] + [("small", f"d{i}") for i in range(6)] + [
        ("big", "d")]
    total = 0
    for r in got:
        assert r.bytes_before == total
        total += r.bytes
        assert r.chosen == (total <= 500_000) and r.files_saved == r.files - r.pieces
    assert not got[-1].chosen and sum(r.chosen for r in got) >= 6
    assert rank_partitions(_facts(spark, []), mb).count() == 0
    assert rank_partitions(_facts(spark, rows), 64 * mb).where("not chosen").count() == 0


def test_what_the_budget_leaves_over_is_reported(spark, sf_small):
    path = small_file_table(spark, sf_small)
    before = _files(spark, path)
    size = file_counts(spark, path).agg(F.sum("bytes")).first()[0]
    rows = {r.status: r for r in compact_all(spark, path, budget_bytes=size // 3).collect()}
    todo = sum(v >= 2 for v in before.values())
    assert 0 < rows["compacted"].partitions < todo
    assert rows["deferred"].partitions == todo - rows["compacted"].partitions
    steps = run_maintenance(spark, MaintainParams(
        table_path=path, compact_by_partition=False, compact_budget_bytes=1, vacuum=False)).steps
    assert [r.status for r in steps.collect()] == ["ok", "ok", "deferred", "ok"]
    compact_all(spark, path)
    assert set(_files(spark, path).values()) == {1} and read_table(spark, path).count() == 1000


@pytest.mark.parametrize("spoil", ["lose", "double", "swap"])
def test_a_rewrite_that_changes_rows_is_a_failed_step(spark, sf_small, monkeypatch, spoil):
    import lakeferry.operators.compact as C

    path = small_file_table(spark, sf_small)
    pieces = C._pieces

    def bad(rows, keys):
        out = pieces(rows, keys)
        one = F.col("creation_time") == out.agg(F.min("creation_time")).first()[0]
        if spoil == "lose":
            return out.where(~one)
        if spoil == "double":
            return out.unionByName(out.where(one))
        return out.withColumn("message_id", F.when(one, F.lit("x")).otherwise(F.col("message_id")))

    monkeypatch.setattr(C, "_pieces", bad)
    steps = {r.step: r for r in run_maintenance(spark, MaintainParams(
        table_path=path, as_of="2024-01-30", vacuum=False)).steps.collect()}
    assert steps["compact"].status == "failed" and "wrote" in steps["compact"].detail


def test_equal_rows_are_dealt_over_all_pieces(spark):
    from lakeferry.operators.messages import enrich
    from lakeferry.sources.synth import literal_messages

    path = scratch_path(spark, "tombstones")
    one = enrich(literal_messages(spark, [(None, None, None, None)]))
    rows = one.select(F.explode(F.sequence(F.lit(1), F.lit(60_000))).alias("i"), "*").drop("i")
    write_table(rows.repartition(24), path, optimize_write=False)
    size = file_counts(spark, path).first()["bytes"]
    compact_all(spark, path, target_file_bytes=size // 8)
    from lakeferry.sources.table import list_data_files

    rows = [r.rows for r in list_data_files(spark, path).collect()]
    assert sum(rows) == 60_000 and 4 <= len(rows) <= 10 and max(rows) < 30_000


def test_vacuum_takes_what_the_scan_does_not_yield(spark, sf_small):
    path = small_file_table(spark, sf_small)
    local = path.removeprefix("file:")
    part = f"{local}/partition_message_type=click/partition_date=2024-01-30"
    past = time.time() - 200 * 3600
    for name, old in (("old.tmp", True), ("young.tmp", False), ("old file %20.bak", True)):
        with open(f"{part}/{name}", "w") as f:
            f.write("x")
        if old:
            os.utime(f"{part}/{name}", (past, past))
    for f in os.listdir(part):  # age alone takes no file of the table
        if f.endswith(".parquet"):
            os.utime(f"{part}/{f}", (past, past))
    names = lambda df: sorted(os.path.basename(r.path) for r in df.collect())
    assert names(vacuum(spark, path, dry_run=True)) == ["old file %20.bak", "old.tmp"]
    assert os.path.exists(f"{part}/old.tmp")
    assert names(vacuum(spark, path)) == ["old file %20.bak", "old.tmp"]
    assert not os.path.exists(f"{part}/old.tmp") and os.path.exists(f"{part}/young.tmp")
    assert read_table(spark, path).count() == 1000


def test_foreign_and_unfinished_folders_are_no_table(spark):
    foreign, unfinished = scratch_path(spark, "foreign"), scratch_path(spark, "unfinished")
    spark.range(5).write.parquet(foreign)
    spark.createDataFrame([("a", 1)], "message_type string, creation_time long").write.parquet(
        unfinished + "/_temporary/0")
    for path in (foreign, unfinished):
        assert compact_table(spark, path).first().status == "no_table"
        steps = run_maintenance(spark, MaintainParams(table_path=path)).steps.collect()
        assert [tuple(r) for r in steps] == [("guard", "no_table", path)]
