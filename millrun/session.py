"""Session construction and the shared checkpoint folder.

On a cluster the operator relies on ``spark.checkpoint.dir`` pointing at a
shared, reliable file system (HDFS/S3/...). We never invent a machine-local
folder there; only a ``local[...]`` master (tests, bench) gets a scratch
folder, and only when the setting is absent.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Session settings that hold unless the submit says otherwise.
_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Session windows: merge sessions map-side before the shuffle, so one
    # busy key does not ship every heartbeat to a single reducer.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "millrun",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session. Without ``master`` the submit decides master, memory and
    shuffle partitions, and no setting that it passed is changed; a local
    master (tests, bench) gets local sizes. A master that is not local must
    come with a shared ``spark.checkpoint.dir``."""
    builder = SparkSession.builder.appName(app_name)
    conf = dict(_CONF)
    if master is None:
        SparkContext._ensure_initialized()  # so that the submit's settings can be read
        submitted = SparkConf()
        conf = {k: v for k, v in conf.items() if not submitted.contains(k)}
    else:
        builder = builder.master(master)
        if master.startswith("local"):
            conf["spark.sql.shuffle.partitions"] = os.environ.get("BENCH_CPUS", "8")
            conf["spark.driver.memory"] = "8g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root (``spark.checkpoint.dir``).

    If unset, a local master gets a fresh scratch folder; any other master
    must configure a shared folder — a machine-local path would not survive
    the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: the server owns the setting
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf:
            raise RuntimeError("spark.checkpoint.dir is not set on the remote session")
        return conf.rstrip("/")
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) before running millrun jobs on a cluster"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="millrun-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def cluster_conf(input_bytes: int, total_cores: int, shuffle_ratio: float = 0.5) -> dict[str, str]:
    """Settings for a cluster run sized from the input, to pass to
    ``spark-submit --conf`` or ``build_session(extra=...)``.

    * Scan splits of 512 MiB: ~200k tasks for 100 TB instead of ~800k.
    * Shuffle partitions so one reducer reads ~256 MiB of the expected
      shuffle (``shuffle_ratio`` x input after projection/partial
      aggregation), never fewer than 3 waves of the cluster's cores; AQE
      then coalesces small partitions and splits skewed ones.
    * RocksDB state store with changelog checkpoints for the streaming
      jobs' per-key state (millions of parts stay off the JVM heap).
    """
    mib = 1 << 20
    shuffle_parts = max(3 * total_cores, int(input_bytes * shuffle_ratio / (256 * mib)))
    return {
        "spark.sql.files.maxPartitionBytes": str(512 * mib),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * mib),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * mib),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
