"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import sys
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

# Settings every job wants; anything the cluster already set wins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Files of checkpoint() are deleted once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Sizing for very large inputs (tens of TB on hundreds of executors): bigger
# scan splits, many initial shuffle partitions that AQE coalesces to ~256 MB,
# skew splitting, and a broadcast threshold that only small dimensions pass.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "40000",
    # Streams: rows of a topic's file, bytes and order lines of a micro-batch, rows of a bucket.
    "spark.tidewater.stream.fileRows": "5000000",
    "spark.tidewater.stream.bytesPerTrigger": "64000000000",
    "spark.tidewater.stream.orderLines": "100000000",
    "spark.tidewater.stream.bucketRows": "1000000",
}


def get_spark(app: str = "tidewater", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with the defaults above (``cluster`` adds
    ``CLUSTER_CONF``).  Settings passed in ``extra`` win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the checkpoint folder, setting one only where none is configured.

    On a cluster the folder must be shared storage named by the cluster
    (``spark.checkpoint.dir``); a machine-local folder would lose data with
    its executor, so an unset value is an error there.  Local sessions
    (tests, benchmarks) get a fresh folder under the system temp dir.
    """
    found = checkpoint_dir(spark)
    if found:
        return found
    if fallback is None:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage")
        fallback = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    os.makedirs(fallback, exist_ok=True) if "://" not in fallback else None
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir()


#: Folders that a session made in the shared folder, by application, and how often
#: they were cleared (what was derived from them has to be made again after that).
_SCRATCH: dict[str, list[str]] = {}
_CLEARED = {"times": 0}


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the driver and all executors share.  What is
    written there goes with ``clear_scratch``, at the latest when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_clear_all)
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage,
    survives lost executors, and several uses share one computation.  ``discard``
    removes the folder when nothing reads it any more."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove the folders of tables that ``materialise`` returned."""
    for table in tables:
        path, spark = table.stored_at, table.sparkSession
        delete_path(spark, path)
        made = _SCRATCH.get(spark.sparkContext.applicationId, [])
        if path in made:
            made.remove(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything the session made in the shared folder, when all results that
    were read from there are done with.  Chains and streams that later queries would
    have shared run again."""
    _CLEARED["times"] += 1
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        delete_path(spark, path)


def scratch_generation() -> int:
    """Changes whenever shared tables were cleared: a part of the key of what is kept."""
    return _CLEARED["times"]


def delete_path(spark: SparkSession, path: str) -> None:
    _delete(spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), path)


def _delete(jvm, conf, path: str) -> None:
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(conf).delete(folder, True)


def _clear_all() -> None:
    """When the driver ends: the session may be stopped, the JVM still runs."""
    jvm = SparkContext._jvm
    for path in [p for made in _SCRATCH.values() for p in made] if jvm else []:
        try:
            _delete(jvm, jvm.org.apache.hadoop.conf.Configuration(), path)
        except Exception as e:  # noqa: BLE001 - the driver is going; say what stays
            print(f"left behind: {path} ({type(e).__name__})", file=sys.stderr)
