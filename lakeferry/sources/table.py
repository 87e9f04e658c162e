"""The partitioned message table: existence guard, scans, writes and file facts.

Delta is used when its classes are loaded and the path holds a Delta log; otherwise the
table is a Parquet directory laid out ``partition_message_type=…/partition_date=…/``, and
beside it, hidden from other readers, ``_ingest/ingest_batch_id=…/`` with a folder of the
same layout for every micro-batch that compaction has not folded in yet. A scan reads both.
Parquet layouts are always read with the explicit table schema: inferring it would turn
``partition_date`` into DATE.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.schema import MESSAGE, MESSAGE_TABLE, PARTITION_KEYS
from lakeferry.session import checkpoint_root, conf_scope, delta_available

BATCH_ID = "ingest_batch_id"
# In a batch folder the id is a partition, in folded files a data column.
_STORED = T.StructType([*MESSAGE_TABLE.fields, T.StructField(BATCH_ID, T.StringType())])
COLUMNS = [f.name for f in MESSAGE_TABLE.fields]


def _fs_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def ingest_root(path: str) -> str:
    return path.rstrip("/") + "/_ingest"


def batch_folder(path: str, query: str, batch_id: int) -> str:
    """Where one micro-batch of a streaming query lives until it is folded in."""
    return f"{ingest_root(path)}/{BATCH_ID}={query}_{batch_id}"


def _first_file(spark: SparkSession, path: str) -> str | None:
    """Some visible Parquet file below ``path``."""
    if not path_exists(spark, path):
        return None
    fs, root = _fs_path(spark, path)
    depth = root.depth()
    files = fs.listFiles(root, True)
    while files.hasNext():
        f = files.next().getPath()
        at, seen = f, f.getName().endswith(".parquet")
        while seen and at.depth() > depth:
            seen, at = not at.getName().startswith(("_", ".")), at.getParent()
        if seen:
            return f.toString()
    return None


def _holds_messages(spark: SparkSession, file: str | None) -> bool:
    if file is None:
        return False
    found = {f.name: f.dataType for f in spark.read.parquet(file).schema.fields}
    return all(found.get(f.name) == f.dataType for f in MESSAGE.fields)


def table_format(spark: SparkSession, path: str) -> str | None:
    """``"delta"``, ``"parquet"`` or ``None``. A Parquet layout is a table when the footer
    of one of its files holds the message columns; foreign files, leftovers of writes that
    never ended and an empty folder are none."""
    if not path_exists(spark, path):
        return None
    if path_exists(spark, path.rstrip("/") + "/_delta_log"):
        if not delta_available(spark):
            raise RuntimeError(
                f"{path} is a Delta table but Delta is not loaded; start Spark with "
                "--packages io.delta:delta-spark_2.13:<version> and build_session(delta=True)"
            )
        return "delta"
    for part in (path, ingest_root(path)):
        if _holds_messages(spark, _first_file(spark, part)):
            return "parquet"
    return None


def is_table(spark: SparkSession, path: str) -> bool:
    """The existence guard of the maintenance job."""
    return table_format(spark, path) is not None


def _scan(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema(_STORED).option("basePath", path)
            .option("pathGlobFilter", "*.parquet").parquet(path))


def scans(spark: SparkSession, path: str) -> list[DataFrame]:
    """The folded part of a Parquet layout and, if there is any, that of the batches, each
    with ``ingest_batch_id`` after the table's columns."""
    parts = [path, ingest_root(path)]
    return [_scan(spark, p) for p in parts if path_exists(spark, p)]


def read_table(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Scan the table. Filters on the partition keys prune directories / files."""
    fmt = fmt or table_format(spark, path)
    if fmt == "delta":
        return spark.read.format("delta").load(path)
    if fmt == "parquet":
        return reduce(DataFrame.unionByName, [s.select(*COLUMNS) for s in scans(spark, path)])
    raise FileNotFoundError(f"no table at {path}")


def register_view(spark: SparkSession, path: str, name: str = "messages") -> DataFrame:
    """Expose the table to SQL under ``name`` (what ``FROM delta.`path` `` gives on Delta),
    with the string-typed partition keys of :func:`read_table`."""
    df = read_table(spark, path)
    df.createOrReplaceTempView(name)
    return df


def register_table(spark: SparkSession, path: str, name: str = "messages") -> None:
    """A catalog table over the layout: schema and partition columns are declared, and the
    partitions are taken into the catalog, so that SQL on ``name`` plans from their names
    without a listing. Batches not folded yet are a table of their own, and ``name`` is a
    view over both then. Call again after writes, to take in new partitions."""
    columns = [f"{f.name} {f.dataType.simpleString()}" for f in _STORED.fields]
    parts = {f"{name}_folded": (path, PARTITION_KEYS),
             f"{name}_batches": (ingest_root(path), (BATCH_ID, *PARTITION_KEYS))}
    made = []
    for table, (root, keys) in parts.items():
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        if path_exists(spark, root):
            quoted = root.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"CREATE TABLE {table} ({', '.join(columns)}) USING parquet "
                      f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{quoted}'")
            spark.catalog.recoverPartitions(table)
            made.append(f"SELECT {', '.join(COLUMNS)} FROM {table}")
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {name} AS {' UNION ALL '.join(made)}")


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    fmt: str = "parquet",
    optimize_write: bool = True,
    replace: str = "table",
) -> None:
    """Write rows partitioned by the two keys.

    ``optimize_write`` adds a ``REBALANCE`` on the keys: one shuffle that gives about one
    file per key and batch, while AQE splits a hot key into advisory-size pieces and merges
    small ones — so a type holding a third of the rows is written by many tasks, not one.
    ``mode="overwrite"`` replaces the whole table (``replace="table"``), or with
    ``replace="partitions"`` only the partitions present in ``df`` (dynamic overwrite:
    every other partition keeps its files).
    """
    if replace not in ("table", "partitions"):
        raise ValueError("replace must be 'table' or 'partitions'")
    if optimize_write:
        df = df.hint("rebalance", *PARTITION_KEYS)
    w = df.write.mode(mode).partitionBy(*PARTITION_KEYS)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
    w.format(fmt).save(path)


def list_data_files(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The files that the table scan reads: path, keys, size, modification time, rows, and
    the batch id of a file not folded yet (null for the others).

    The facts are the scan's own ``_metadata`` columns; no data column is read, so a task
    opens footers only, and ``where`` (on the keys) prunes directories. On Delta the scan
    yields the live files. A file without rows yields none.
    """
    if table_format(spark, path) == "delta":
        parts = [spark.read.format("delta").load(path).withColumn(BATCH_ID, F.lit(None))]
    else:
        parts = scans(spark, path)
    facts = []
    for i, part in enumerate(parts):
        part = part if where is None else part.where(where)
        unfolded = F.col(BATCH_ID) if i else F.lit(None).cast("string")
        facts.append(part.select(
            F.col("_metadata.file_path").alias("path"), *PARTITION_KEYS,
            F.col("_metadata.file_size").alias("size_bytes"),
            F.unix_millis("_metadata.file_modification_time").alias("modified_ms"),
            unfolded.alias(BATCH_ID)))
    rows = reduce(DataFrame.unionByName, facts)
    return rows.groupBy(rows.columns).agg(F.count(F.lit(1)).alias("rows"))


_FOOTERS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
            "spark.sql.parquet.aggregatePushdown": "true"}


def footer_row_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows per (type, date) of a Parquet layout from the row counts of the footers alone:
    the aggregate is pushed into the scan, which returns a row per file. The result is
    cut with ``checkpoint()``, since the push-down holds inside this call only."""
    checkpoint_root(spark)
    with conf_scope(spark, _FOOTERS):
        parts = [s.groupBy(*PARTITION_KEYS).agg(F.count(F.lit(1)).alias("row_count"))
                 for s in scans(spark, path)]
        out = [p.checkpoint() for p in parts]
    if len(out) == 1:
        return out[0]
    return reduce(DataFrame.unionByName, out).groupBy(*PARTITION_KEYS).agg(
        F.sum("row_count").alias("row_count"))
