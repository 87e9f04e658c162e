"""Scratch tables in the shared checkpoint folder, and small helpers of all operators."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import conf_scope, scratch_path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> None:
    """Holds Arrow batches to ``limit`` bytes, so a Python worker has a few MB of whole
    texts at a time however long they are; a smaller limit of the session's own stays."""
    to_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if to_bytes(spark.conf.get(_BATCH)) > limit:
        spark.conf.set(_BATCH, str(limit))


_M_TRIM_THRESHOLD, _M_MMAP_THRESHOLD = -1, -3


def lean(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``fn`` of batches for ``mapInArrow``, in a worker that gives memory back: Spark keeps
    Python workers for later stages, and what the allocator kept would stay theirs. Blocks
    of 256 KB or more go back when freed, the rest when a task ends."""

    def run(batches):
        try:
            libc = ctypes.CDLL("libc.so.6")
            libc.mallopt(_M_MMAP_THRESHOLD, 1 << 18)
            libc.mallopt(_M_TRIM_THRESHOLD, 1 << 20)
            trim = libc.malloc_trim
        except (OSError, AttributeError):  # another C library: nothing to tune
            trim = None
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim:
                trim(0)

    return run


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Bytes of a row group of a scratch table, which its writing task holds in memory.
ROW_GROUP = 32 << 20


class Scratch:
    """Tables written under ``spark.checkpoint.dir`` (see ``session.scratch_path``). They
    cut lineage: a lost executor costs the tasks of one step, never the steps before it.
    ``drop`` removes tables that nothing reads any more; a table that a returned frame
    still reads is left to the folder's owner."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"llm-{name}")
        # what was shuffled for the table is not read again: its files go at once
        with conf_scope(self.spark, {_CLEANUP: "true"}):
            df.write.option("compression", "zstd").option(
                "parquet.block.size", str(ROW_GROUP)).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        sc = self.spark.sparkContext
        for t in tables:
            path = sc._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def map_arrow(
    df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: str | T.StructType
) -> DataFrame:
    """``mapInArrow`` for functions that turn a batch into dicts of column values."""
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(st)
    small_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            for cols in fn(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[f.name], f.type) if not isinstance(cols[f.name], pa.Array)
                     else cols[f.name].cast(f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(lean(run), st)


def bucket_of(col: Column | str, n: int | Column) -> Column:
    """Even buckets 0 .. n-1 by hash."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.pmod(F.xxhash64(F.lit(7), col), n.cast("long"))


def few_tasks(df: DataFrame, rows: float, a_task: int) -> DataFrame:
    """``df`` in as many tasks as its rows (or bytes) call for, ``a_task`` in each, twice the
    cores at least: a small table in hundreds of shuffle partitions costs more for starting
    tasks, Python workers and files than for its rows. Spark joins small partitions itself
    unless ``spark.sql.adaptive.coalescePartitions.enabled`` is off; only then the rows are
    dealt out anew, evenly, if that makes fewer tasks. (Not by ``coalesce``: a task that runs
    many sort-merge joins in turn keeps the memory of all of them.)"""
    spark = df.sparkSession
    on = (spark.conf.get(f"spark.sql.adaptive.{x}") == "true"
          for x in ("enabled", "coalescePartitions.enabled"))
    n = max(2 * spark.sparkContext.defaultParallelism, math.ceil(rows / a_task))
    if all(on) or n >= int(spark.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(n)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, mod n (a null id counts as an empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))
