"""Session building, connector detection and shared scratch locations."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every job here relies on. AQE is on by default in Spark 4 but is
# stated so that rebalance/coalescing behaviour does not depend on the cluster default.
# Broadcast joins are decided only at run time, from measured shuffle sizes: the static
# planner's estimate (compressed file size) is not a proven bound, so it may not broadcast.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A small shuffle (a micro-batch, a compaction window) is still spread over the cores
    # instead of being coalesced into one task: a rebalance on the partition keys then
    # writes its per-key files from many tasks at once. Coalescing never splits a key, so
    # the file count stays the same; large shuffles are sized by the advisory size.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

DELTA_CONF = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
    "spark.databricks.delta.optimizeWrite.enabled": "true",
    "spark.databricks.delta.autoCompact.enabled": "true",
}


def build_session(
    app_name: str = "lakeferry",
    master: str | None = None,
    delta: bool = False,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session for the ingest and maintenance jobs.

    ``delta=True`` adds the Delta extension and catalog; only pass it when the Delta jars
    are on the class path (``--packages io.delta:delta-spark_2.13:<version>``).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    settings = dict(BASE_CONF)
    if delta:
        settings.update(DELTA_CONF)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def object_store_conf(
    endpoint: str, access_key: str, secret_key: str, path_style: bool = True, ssl: bool = False
) -> dict[str, str]:
    """S3A settings for an S3-compatible store (keys without the ``spark.hadoop.`` prefix)."""
    return {
        "fs.s3a.endpoint": endpoint,
        "fs.s3a.access.key": access_key,
        "fs.s3a.secret.key": secret_key,
        "fs.s3a.path.style.access": str(path_style).lower(),
        "fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def configure_object_store(spark: SparkSession, settings: dict[str, str]) -> None:
    """Apply S3A settings to a running session.

    SQL-conf entries are copied into the Hadoop configuration of every DataFrame read and
    write; the context's Hadoop configuration gets them too, for the direct file-system
    calls (table guard, stream commit markers, vacuum listing). At build time pass them as
    ``spark.hadoop.<key>`` instead.
    """
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for k, v in settings.items():
        spark.conf.set(k, v)
        hadoop.set(k, v)


@contextlib.contextmanager
def conf_scope(spark: SparkSession, settings: dict[str, str]):
    """Set SQL confs for the duration of a block (for eager actions inside it) and restore
    the previous values afterwards."""
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


_PROBES: dict[tuple[int, str], bool] = {}


def _probe(spark: SparkSession, name: str, fn) -> bool:
    key = (id(spark), name)
    if key not in _PROBES:
        try:
            fn()
            _PROBES[key] = True
        except Exception:  # connector missing: the caller picks the fallback
            _PROBES[key] = False
    return _PROBES[key]


def delta_available(spark: SparkSession) -> bool:
    """True when the Delta classes are loadable in this session's JVM."""
    return _probe(
        spark, "delta", lambda: spark._jvm.java.lang.Class.forName("io.delta.tables.DeltaTable")
    )


def delta_session(spark: SparkSession) -> bool:
    """True when the session was built with the Delta extension: new tables are Delta then."""
    return "DeltaSparkSessionExtension" in (spark.conf.get("spark.sql.extensions", "") or "")


def kafka_available(spark: SparkSession) -> bool:
    """True when the Kafka source is on the class path."""
    return _probe(
        spark,
        "kafka",
        lambda: spark._jvm.java.lang.Class.forName(
            "org.apache.spark.sql.kafka010.KafkaSourceProvider"
        ),
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when neither the context nor the conf names one and the master is local (tests)
    is a folder of our own created and registered; a cluster session without one is an
    error, since a driver-local folder is not visible to the executors.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by the cluster (HDFS, object "
                "store); scratch tables and checkpoints are written there"
            )
        conf = tempfile.mkdtemp(prefix="lakeferry-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/lakeferry/{name}-{uuid.uuid4().hex[:12]}"
