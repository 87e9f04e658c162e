"""Small-file compaction and file-count reports.

Delta tables use Delta's own ``OPTIMIZE`` (safe next to a running writer). Parquet layouts
are rewritten by Spark jobs that read the chosen partitions (partition-pruned), deal their
rows into as many pieces as their bytes need, and write them back with dynamic partition
overwrite, so only the chosen partition directories are replaced.

Scale notes for the Parquet rewrite:
* one read, one shuffle, one write for up to ``JOB_PARTITIONS`` partitions;
* partitions whose file count cannot fall are skipped (the scan's file facts show them), so
  re-running over a window rewrites only the partitions written to since;
* with a byte budget the partitions that save most files per byte rewritten go first, and
  what is left over is reported;
* rows are dealt by their place in their file, so a hot partition, or one of equal rows, is
  split into pieces of equal size over as many tasks;
* micro-batches of the stream are folded in: their rows keep the batch id, so a batch whose
  folder outlives the rewrite (a lost driver) is known and not folded again. The newest batch
  of a query stays as it is: a restart may replace it;
* rows and an order-free checksum are counted where rows are read and where they are
  written, and rows once more in the footers of what was written: a rewrite that loses or
  doubles a row is a failure;
* the old files are removed only when the job commits, so a lost executor just makes its
  tasks rerun from the (still present) old files;
* not isolated from a concurrent writer: run it between ``availableNow`` ingest runs,
  never beside a live stream into the same Parquet path.
"""

from __future__ import annotations

import dataclasses
import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lakeferry.operators.stats import (
    any_of,
    date_predicates,
    date_window,
    in_window,
    recent_partitions,
    validate_predicates,
)
from lakeferry.schema import PARTITION_KEYS
from lakeferry.session import checkpoint_root, conf_scope
from lakeferry.sources.table import (
    BATCH_ID,
    COLUMNS,
    _fs_path,
    ingest_root,
    list_data_files,
    path_exists,
    read_table,
    scans,
    table_format,
    write_table,
)

STATUS_SCHEMA = "target string, status string, error string, partitions long, rows long"

log = logging.getLogger(__name__)

# Size compaction aims at per output file: AQE's advisory partition size during the
# rewrite. A key larger than this is split into files of about this size.
DEFAULT_TARGET_FILE_BYTES = 256 * 1024 * 1024

# Partitions rewritten by one job; a pass over more of them is several jobs of the same
# plan, so the list of one job's partitions, which is broadcast, has a fixed bound.
JOB_PARTITIONS = 20_000


def error_text(e: Exception) -> str:
    """The whole message of an error, or its type when it has none."""
    return str(e).strip() or type(e).__name__


def _delta_table(spark: SparkSession, path: str):
    return spark._jvm.io.delta.tables.DeltaTable.forPath(spark._jsparkSession, path)


def rank_partitions(
    files: DataFrame, target_bytes: int, budget_bytes: int | None = None
) -> DataFrame:
    """Partitions whose file count a rewrite lowers, by files saved per byte rewritten, from
    file facts (:func:`list_data_files`): no data file is opened.

    Columns: keys, ``files``, ``bytes``, the ``pieces`` a rewrite makes, ``files_saved``,
    ``bytes_before`` (what the partitions ranked higher take) and ``chosen`` (fits the
    budget after those; all do without one). Ties go by fewer bytes, then by key. A
    partition of as few files as its bytes need is left out, also when they are under the
    target, so a second pass rewrites nothing.

    The running sum has two levels, a few hundred classes of benefit and the partitions of
    a class, so no task holds all partitions.
    """
    size = F.col("size_bytes")
    todo = (
        files.groupBy(*PARTITION_KEYS)
        .agg(F.count_if(size < F.lit(target_bytes)).alias("small_files"),
             F.count(F.lit(1)).alias("files"), F.sum(size).alias("bytes"))
        .withColumn("pieces", F.ceil(F.col("bytes") / F.lit(target_bytes)))
        .where((F.col("small_files") >= 2) & (F.col("files") > F.col("pieces")))
        .withColumn("files_saved", F.col("files") - F.col("pieces"))
        .withColumn("_benefit", F.col("files_saved") / F.col("bytes"))
        .withColumn("_class", F.floor(F.log2("_benefit") * 4))
    )
    above = Window.orderBy(F.desc("_class")).rowsBetween(Window.unboundedPreceding, -1)
    classes = todo.groupBy("_class").agg(F.sum("bytes").alias("_bytes")).select(
        "_class", F.coalesce(F.sum("_bytes").over(above), F.lit(0)).alias("_above"))
    within = Window.partitionBy("_class").orderBy(
        F.desc("_benefit"), "bytes", *PARTITION_KEYS).rowsBetween(Window.unboundedPreceding, -1)
    ranked = todo.join(classes, "_class").withColumn(
        "bytes_before", F.col("_above") + F.coalesce(F.sum("bytes").over(within), F.lit(0)))
    fits = F.lit(True) if budget_bytes is None else (
        F.col("bytes_before") + F.col("bytes") <= F.lit(budget_bytes))
    return ranked.select(*PARTITION_KEYS, "files", "bytes", "pieces", "files_saved",
                         "bytes_before", fits.alias("chosen"))


def _key_in(keys: list[tuple]) -> Column:
    """Partition predicate: (type, date) is one of ``keys`` (nulls match nulls)."""
    def pair(row):
        return F.struct(*[F.lit(v).cast("string").alias(k) for k, v in zip(PARTITION_KEYS, row)])

    return F.struct(*PARTITION_KEYS).isin([pair(r) for r in keys])


def _newest_batches(spark: SparkSession, path: str) -> list[str]:
    """The last batch id of every query that has batches beside the table."""
    root, newest = ingest_root(path), {}
    if not path_exists(spark, root):
        return []
    fs, folder = _fs_path(spark, root)
    for st in fs.listStatus(folder):
        name = st.getPath().getName()
        if name.startswith(f"{BATCH_ID}="):
            query, _, number = name[len(BATCH_ID) + 1 :].rpartition("_")
            newest[query] = max(int(number), newest.get(query, -1))
    return [f"{q}_{n}" for q, n in newest.items()]


def _same_key(a: DataFrame, b: DataFrame, *more: str) -> list[Column]:
    return [a[k].eqNullSafe(b[k]) for k in (*PARTITION_KEYS, *more)]


def _settled_rows(spark: SparkSession, path: str, keys: list[tuple], newest: list[str]) -> DataFrame:
    """All rows of the partitions ``keys`` but those of the newest batches, with the place of
    each in its file. A batch that the folded part holds rows of already is left out."""
    here = _key_in([k[:2] for k in keys])  # a partition filter
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("place")
    parts = [s.where(here) for s in scans(spark, path)]
    rows = [p.select(*COLUMNS, BATCH_ID, place) for p in parts]
    if len(parts) == 1:
        return rows[0]
    unfolded = ~F.col(BATCH_ID).isin(newest)
    known = parts[0].where(f"{BATCH_ID} is not null").select(*PARTITION_KEYS, BATCH_ID).distinct()
    waiting = parts[1].where(unfolded).select(*PARTITION_KEYS, BATCH_ID).distinct()
    done = known.join(waiting, _same_key(known, waiting, BATCH_ID), "left_semi").checkpoint()
    fresh = rows[1].where(unfolded)
    if not done.isEmpty():
        fresh = fresh.join(done, _same_key(fresh, done, BATCH_ID), "left_anti")
    return rows[0].unionByName(fresh)


def _pieces(rows: DataFrame, keys: list[tuple]) -> DataFrame:
    """Rows dealt by their place so that each partition gives its number of files. ``keys``
    holds (type, date, pieces) of at most ``JOB_PARTITIONS`` partitions."""
    spark = rows.sparkSession
    plan = spark.createDataFrame(keys, ", ".join(f"k_{k} string" for k in PARTITION_KEYS)
                                 + ", pieces long")
    on = [F.col(k).eqNullSafe(F.col(f"k_{k}")) for k in PARTITION_KEYS]
    tasks = max(spark.sparkContext.defaultParallelism, sum(int(k[2]) for k in keys))
    return (rows.join(F.broadcast(plan), on).withColumn("piece", F.pmod("place", "pieces"))
            .repartition(tasks, *PARTITION_KEYS, "piece").select(*COLUMNS, BATCH_ID))


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, its rows and an order-free checksum of them observed when it is written."""
    seen = Observation()
    check = F.sum(F.xxhash64(*COLUMNS, BATCH_ID).cast("decimal(38,0)"))
    return df.observe(seen, F.count(F.lit(1)).alias("n"), check.alias("checksum")), seen


def _drop_folded(spark: SparkSession, path: str, leaves: list[str]) -> None:
    """Removes folders of folded files, and batches that hold no file any more."""
    fs, root = _fs_path(spark, ingest_root(path))
    jvm, batches = spark._jvm, {}
    for leaf in leaves:
        folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(leaf))
        fs.delete(folder, True)
        batch = folder.getParent().getParent()
        batches[batch.toString()] = batch
    for batch in batches.values():
        left = fs.listFiles(batch, True)
        while left.hasNext():
            if left.next().getPath().getName().endswith(".parquet"):
                break
        else:
            fs.delete(batch, True)


@dataclasses.dataclass(frozen=True)
class Rewritten:
    partitions: int | None = 0
    rows: int | None = 0
    deferred: int = 0  # partitions that the budget left over
    deferred_bytes: int = 0

    @property
    def detail(self) -> str:
        return f"{self.partitions} partitions, {self.rows} rows"

    def status(self) -> list[tuple]:
        """A row for what the budget left over, if anything."""
        if not self.deferred:
            return []
        text = f"{self.deferred} partitions, {self.deferred_bytes} bytes over the budget"
        return [("budget", "deferred", text, self.deferred, None)]


def _rewrite_job(spark: SparkSession, path: str, files: DataFrame, keys: list[tuple],
                 newest: list[str]) -> int:
    """One job: the rows of ``keys`` written anew; returns how many they are."""
    leaves = [r[0] for r in files.where(F.col(BATCH_ID).isNotNull() & _key_in(
        [k[:2] for k in keys])).select(F.regexp_replace("path", "/[^/]*$", "")).distinct().collect()]
    rows, read = _counted(_settled_rows(spark, path, keys, newest))
    out, written = _counted(_pieces(rows, keys))
    write_table(out, path, mode="overwrite", fmt="parquet", optimize_write=False,
                replace="partitions")
    if read.get != written.get:
        raise RuntimeError(f"rewrite of {path} read {read.get} but wrote {written.get}")
    kept = list_data_files(spark, path, _key_in([k[:2] for k in keys])).where(
        F.col(BATCH_ID).isNull()).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if kept != read.get["n"]:
        raise RuntimeError(f"rewrite of {path} read {read.get['n']} rows, its files hold {kept}")
    _drop_folded(spark, path, leaves)
    return kept


def settled_files(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """File facts of what compaction may rewrite, as a table of its own: all files but those
    of the newest batch of a query."""
    checkpoint_root(spark)  # the shared folder must be registered first
    newest = _newest_batches(spark, path)
    files = list_data_files(spark, path, where)
    if newest:
        files = files.where(F.col(BATCH_ID).isNull() | ~F.col(BATCH_ID).isin(newest))
    return files.checkpoint()


def _rewrite(
    spark: SparkSession,
    path: str,
    where: Column | None,
    target_file_bytes: int | None,
    files: DataFrame | None = None,
    budget_bytes: int | None = None,
) -> Rewritten:
    """Rewrite the partitions matched by ``where`` that have too many files. They are found
    from the file facts (or ``files``, which the caller shares between targets). Each
    becomes as many files as its bytes need, so a hot partition is split over tasks and is
    not rewritten again by the next run.
    """
    if files is None:
        files = settled_files(spark, path, where)
    elif where is not None:
        files = files.where(where)
    ranked = rank_partitions(
        files, target_file_bytes or DEFAULT_TARGET_FILE_BYTES, budget_bytes).checkpoint()
    # names and piece counts of partitions, which the table's file index holds here anyway
    keys = [tuple(r) for r in ranked.where("chosen").select(*PARTITION_KEYS, "pieces").orderBy(
        *PARTITION_KEYS).collect()]
    n, newest = 0, _newest_batches(spark, path)
    for i in range(0, len(keys), JOB_PARTITIONS):
        n += _rewrite_job(spark, path, files, keys[i : i + JOB_PARTITIONS], newest)
    left = ranked.where("not chosen").agg(
        F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    return Rewritten(len(keys), n, *left)


def choose_targets(
    spark: SparkSession, path: str, specific: list[str] | None = None, days: int = 7, as_of=None
) -> list[str]:
    """Partitions to compact: the explicit predicate list when given, else one
    ``partition_date = '…'`` predicate per date present in ``[as_of - days, as_of]``."""
    if specific:
        return list(specific)
    # The date list comes from the partition directories alone: Spark answers DISTINCT on
    # partition columns from its file index, without opening a data file. (Safe here:
    # partitioned writes never leave empty files behind.)
    with conf_scope(spark, {"spark.sql.optimizer.metadataOnly": "true"}):
        return date_predicates(recent_partitions(read_table(spark, path), days, as_of))


def compact_partitions(
    spark: SparkSession,
    path: str,
    predicates: list[str],
    per_partition: bool = False,
    target_file_bytes: int | None = DEFAULT_TARGET_FILE_BYTES,
    budget_bytes: int | None = None,
) -> DataFrame:
    """Compact the partitions matched by ``predicates``; returns one status row per target,
    and one for what ``budget_bytes`` (the single job's, Parquet) leaves over.

    ``per_partition=True`` runs one job per predicate and isolates failures (a failing
    predicate is reported and skipped). The default runs a single job over the union of
    the predicates (Parquet), which scales with data rather than with partition count; a
    predicate that does not fit the partition columns is reported as failed there too.
    """
    fmt = table_format(spark, path)
    if fmt is None:
        raise FileNotFoundError(f"no table at {path}")
    rows: list[tuple] = []
    if fmt == "parquet" and not per_partition:
        good = []
        for p in predicates:
            try:
                good += validate_predicates(spark, [p])
            except Exception as e:  # reported, the others still run
                rows.append((p, "failed", error_text(e), None, None))
        if good:
            n = _rewrite(spark, path, any_of(good), target_file_bytes, None, budget_bytes)
            log.info("%s rewritten", n.detail)
            # one job for all: its counts stand in the first row
            rows += [(p, "compacted", None, *((n.partitions, n.rows) if i == 0 else (None, None)))
                     for i, p in enumerate(good)] + n.status()
    else:
        shared = None
        if fmt == "parquet" and len(predicates) > 1:
            # one listing for all targets, cut into the checkpoint folder; each predicate
            # filters it on its own, so a bad predicate still fails only its target. A
            # partition matched by two targets may be rewritten twice, never wrongly:
            # the rewrite reads the table's current files.
            shared = settled_files(spark, path)
        for p in predicates:
            try:
                n = Rewritten(None, None)
                if fmt == "delta":
                    _delta_table(spark, path).optimize().where(p).executeCompaction()
                else:
                    n = _rewrite(spark, path, F.expr(p), target_file_bytes, shared)
                    log.info("%s: %s rewritten", p, n.detail)
                rows.append((p, "compacted", None, n.partitions, n.rows))
            except Exception as e:  # reported per target, the others still run
                rows.append((p, "failed", error_text(e), None, None))
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def compact_recent(
    spark: SparkSession,
    path: str,
    days: int = 7,
    as_of=None,
    target_file_bytes: int | None = DEFAULT_TARGET_FILE_BYTES,
    budget_bytes: int | None = None,
) -> DataFrame:
    """Compact the dates in ``[as_of - days, as_of]`` in one pass (Parquet). The window is a
    text range over all partition names, so any date text inside it counts; only the
    chosen directories are read."""
    fmt = table_format(spark, path)
    if fmt is None:
        raise FileNotFoundError(f"no table at {path}")
    if fmt == "delta":
        lo, hi = date_window(days, as_of)
        where = f"partition_date >= '{lo}' AND partition_date <= '{hi}'"
        _delta_table(spark, path).optimize().where(where).executeCompaction()
    n = None if fmt == "delta" else _rewrite(
        spark, path, in_window(days, as_of), target_file_bytes, None, budget_bytes)
    return _status(spark, f"last {days} days to {as_of}", n)


def _status(spark: SparkSession, target: str, n: Rewritten | None) -> DataFrame:
    rows = [(target, "compacted", None, n and n.partitions, n and n.rows)]
    if n:
        log.info("%s: %s rewritten", target, n.detail)
        rows += n.status()
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def compact_all(
    spark: SparkSession,
    path: str,
    target_file_bytes: int | None = DEFAULT_TARGET_FILE_BYTES,
    budget_bytes: int | None = None,
) -> DataFrame:
    """Compact the whole table."""
    fmt = table_format(spark, path)
    if fmt is None:
        raise FileNotFoundError(f"no table at {path}")
    if fmt == "delta":
        _delta_table(spark, path).optimize().executeCompaction()
    n = None if fmt == "delta" else _rewrite(
        spark, path, None, target_file_bytes, None, budget_bytes)
    return _status(spark, "all", n)


def file_counts(spark: SparkSession, path: str, dates: list[str] | None = None) -> DataFrame:
    """Data files, bytes and rows per partition, from the file facts only (no data read);
    ``dates`` restricts them to those date directories."""
    where = None if dates is None else F.col(PARTITION_KEYS[1]).isin(list(dates))
    return (
        list_data_files(spark, path, where)
        .groupBy(*PARTITION_KEYS)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("bytes"),
             F.sum("rows").alias("rows"))
    )


def file_report(before: DataFrame, after: DataFrame, row_counts: DataFrame) -> DataFrame:
    """Per-partition files and bytes before/after compaction, with row counts.

    ``before`` must be materialised before compaction (``checkpoint()``), since the listing
    it came from no longer exists afterwards.
    """
    b = before.select(*PARTITION_KEYS, F.col("files").alias("files_before"),
                      F.col("bytes").alias("bytes_before")).alias("b")
    a = after.select(*PARTITION_KEYS, F.col("files").alias("files_after"),
                     F.col("bytes").alias("bytes_after")).alias("a")
    c = row_counts.alias("c")
    # null-safe keys: the null (tombstone) partition is one partition, not unmatched rows
    both = b.join(
        a, [F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}")) for k in PARTITION_KEYS], "full_outer"
    ).select(
        *[F.coalesce(F.col(f"b.{k}"), F.col(f"a.{k}")).alias(k) for k in PARTITION_KEYS],
        "files_before", "bytes_before", "files_after", "bytes_after",
    ).alias("f")
    extra = [x for x in row_counts.columns if x not in PARTITION_KEYS]
    return (
        both.join(c, [F.col(f"f.{k}").eqNullSafe(F.col(f"c.{k}")) for k in PARTITION_KEYS],
                  "left")
        .select(*[F.col(f"f.{k}").alias(k) for k in PARTITION_KEYS],
                "files_before", "bytes_before", "files_after", "bytes_after",
                *[F.col(f"c.{x}").alias(x) for x in extra])
        .na.fill(0, ["files_before", "files_after", "bytes_before", "bytes_after"])
    )
