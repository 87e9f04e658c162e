"""Removal of files no longer referenced by the table (vacuum).

:func:`expired_files` is the relational core: every listed file, minus the live ones,
older than the retention cutoff. It is a left-anti join on the path after the age filter;
no side is broadcast by hint — AQE may switch to a broadcast join only after measuring the
live side at run time, otherwise it stays a shuffle join whose size grows with the listing.
"""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.session import checkpoint_root, conf_scope
from lakeferry.sources.table import (
    _fs_path,
    ingest_root,
    list_data_files,
    path_exists,
    table_format,
)

log = logging.getLogger(__name__)

DEFAULT_RETENTION_HOURS = 168
HOUR_MS = 3_600_000

# Name prefixes of what an aborted Spark write leaves in a Parquet table root.
LEFTOVER_PREFIXES = ("_temporary", ".spark-staging-")


def retention_cutoff_ms(retention_hours: int, now_ms: int | None = None) -> int:
    """Files modified before this instant are old enough to delete."""
    now = int(time.time() * 1000) if now_ms is None else now_ms
    return now - retention_hours * HOUR_MS


def expired_files(listing: DataFrame, live: DataFrame, cutoff_ms: int) -> DataFrame:
    """Files of ``listing(path, modified_ms, …)`` not in ``live(path)`` and older than cutoff."""
    return listing.where(F.col("modified_ms") < F.lit(cutoff_ms)).join(
        live.select("path"), "path", "left_anti"
    )


def _only_copies(spark: SparkSession, path: str, staged: str) -> bool:
    """True when a staging folder holds data files of a partition the table has no files of.

    A dynamic overwrite deletes a partition's folder and then renames the staged one; if
    the driver dies in between, the staged files are the only copy."""
    fs, root = _fs_path(spark, path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    files = fs.listFiles(hadoop_path(staged), True)
    while files.hasNext():
        f = files.next().getPath()
        if not f.getName().endswith(".parquet"):
            continue
        keys, at = [], f.getParent()
        while at is not None and "=" in at.getName():
            keys.insert(0, at.getName())
            at = at.getParent()
        target = hadoop_path("/".join([root.toString(), *keys]))
        if not keys or not fs.exists(target) or not fs.listStatus(target):
            return True
    return False


def _leftovers(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Folders of aborted writes at the root of the table and of each unfolded batch."""
    roots = [_fs_path(spark, path)[1]]
    if path_exists(spark, ingest_root(path)):
        fs, root = _fs_path(spark, ingest_root(path))
        roots += [st.getPath() for st in fs.listStatus(root) if st.isDirectory()]
    fs, out = _fs_path(spark, path)[0], []
    for root in roots:
        for st in fs.listStatus(root):
            if st.getPath().getName().startswith(LEFTOVER_PREFIXES):
                out.append((st.getPath().toString(), int(st.getModificationTime())))
    return out


def _all_files(spark: SparkSession, path: str) -> DataFrame:
    """Every visible file under the table and its batches, of any name: Spark's own parallel
    listing, contents never read. Spark leaves files of no bytes out."""
    roots = [p for p in (path, ingest_root(path)) if path_exists(spark, p)]
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(roots)
    return listing.select(
        F.col("_metadata.file_path").alias("path"), F.col("path").alias("name"),
        F.unix_millis("modificationTime").alias("modified_ms"))


def _delta_vacuum_sql(path: str, retention_hours: int, dry_run: bool) -> str:
    quoted = path.replace("`", "``")
    return f"VACUUM delta.`{quoted}` RETAIN {retention_hours} HOURS" + " DRY RUN" * dry_run


def vacuum(
    spark: SparkSession,
    path: str,
    retention_hours: int = DEFAULT_RETENTION_HOURS,
    dry_run: bool = False,
    now_ms: int | None = None,
    allow_short_retention: bool = False,
) -> DataFrame:
    """Delete unreferenced files older than ``retention_hours``; returns what was (or would
    be, with ``dry_run``) deleted as ``path, modified_ms`` (no time on Delta).

    Delta: Delta's own ``VACUUM``. Parquet: the files under the table, of any name, minus
    those the table scan yields, by :func:`expired_files`; and the folders aborted writes
    leave at the root of the table or of a batch. A staging folder that holds the only copy
    of a partition counts as live: it is logged and kept, to be moved back by hand.
    A retention under 168 h is refused unless ``allow_short_retention`` — a shorter one can
    delete files a running reader or writer still needs.
    """
    if retention_hours < DEFAULT_RETENTION_HOURS and not allow_short_retention:
        raise ValueError(
            f"retention of {retention_hours} h is below {DEFAULT_RETENTION_HOURS} h; "
            "pass allow_short_retention=True if no reader or writer can still need the files"
        )
    fmt = table_format(spark, path)
    if fmt is None:
        raise FileNotFoundError(f"no table at {path}")
    if fmt == "delta":
        check = {"spark.databricks.delta.retentionDurationCheck.enabled": "false"}
        with conf_scope(spark, check if allow_short_retention else {}):
            checkpoint_root(spark)  # the list must be kept before the files go
            gone = spark.sql(_delta_vacuum_sql(path, retention_hours, True)).select(
                "path", F.lit(None).cast("long").alias("modified_ms")).checkpoint()
            if not dry_run:
                spark.sql(_delta_vacuum_sql(path, retention_hours, False)).collect()
        return gone
    cutoff = retention_cutoff_ms(retention_hours, now_ms)
    checkpoint_root(spark)
    # footers and names only: as few, large splits as there are cores
    with conf_scope(spark, {"spark.sql.files.maxPartitionBytes": str(1 << 50)}):
        strays = expired_files(
            _all_files(spark, path), list_data_files(spark, path), cutoff).checkpoint()
    left = _leftovers(spark, path)
    only = {p for p, _ in left if _only_copies(spark, path, p)}
    for p in only:
        log.warning("kept %s: it holds the only files of a partition", p)
    folders = spark.createDataFrame(
        [(p, t) for p, t in left if t < cutoff and p not in only], "name string, modified_ms long")
    gone = strays.select("name", "modified_ms").unionByName(folders).checkpoint()
    if not dry_run:
        fs, _ = _fs_path(spark, path)
        for r in gone.toLocalIterator():
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(r["name"]), True)
    return gone.withColumnRenamed("name", "path")
