"""Spark session helpers.

The library never owns the cluster configuration: analyses take the session
they are given.  ``tune`` only sets SQL options that can change at run time
(adaptive execution, skew handling) and ``checkpoint_dir`` reads the shared
folder the cluster names in ``spark.checkpoint.dir``; a private folder is made
only when that setting is absent (local runs and tests).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL options.  Adaptive execution re-plans joins from real shuffle
# sizes (a broadcast is chosen only when the measured side is below the
# threshold), coalesces small shuffle partitions and splits skewed ones.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join also where that costs the aggregate above it a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A partition is skewed when it is 5x the median and above 256 MB.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Shuffle-hash joins may be chosen after AQE sees small partitions.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``RUNTIME_CONF`` to a session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "forumlens", driver_memory: str = "16g",
                  event_log_dir: str | None = None) -> SparkSession:
    """A local session for tests, the bench and the examples.

    ``event_log_dir`` turns on Spark's event log there (stage and task
    times for later inspection; the web UI stays off).
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Uses ``spark.checkpoint.dir`` when the cluster sets it.  A local master
    (one machine: runs by hand, tests) gets a private folder otherwise; on a
    cluster a missing setting is an error, since executors would each write
    to a disk of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="forumlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (one file-system summary per path)."""
    sc = spark.sparkContext
    conf = sc._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        jp = sc._jvm.org.apache.hadoop.fs.Path(p)
        fs = jp.getFileSystem(conf)
        if fs.exists(jp):
            total += int(fs.getContentSummary(jp).getLength())
    return total


def size_shuffles(spark: SparkSession, total_bytes: int,
                  bytes_per_partition: int = 1 << 30,
                  lo: int = 200) -> int:
    """Size the first shuffle of a job from its input size.

    Adaptive execution starts every shuffle with ``initialPartitionNum``
    partitions and coalesces them towards the advisory size (128 MB), so the
    start only has to be large enough that no reducer partition of the
    biggest shuffle outgrows executor memory: one partition per GiB of input
    and ``lo`` at least.  Returns the partition count it set.
    """
    n = max(lo, -(-total_bytes // bytes_per_partition))
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(n, current)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
