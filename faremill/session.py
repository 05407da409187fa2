"""Session set-up: UTC days, adaptive plans, shuffles sized from the input."""

from __future__ import annotations

import atexit
import tempfile

from pyspark.sql import SparkSession

#: Bytes of input one initial shuffle partition should stand for. Adaptive execution merges
#: partitions that turn out smaller, so the number only has to be large enough.
BYTES_PER_SHUFFLE_PARTITION = 128 * 1024 * 1024

#: Bytes of files one task reads at most. Compressed rows grow many times over in memory and copies are
#: dropped there by a sort, which must fit a task's share of an executor or it spills all it read.
BYTES_PER_READ = 32 * 1024 * 1024

CHECKPOINT_DIR = "spark.checkpoint.dir"
_SETTINGS = {
    # Days are UTC days in every table.
    "spark.sql.session.timeZone": "UTC",
    # A bad cast must fail the job, as it does in a warehouse.
    "spark.sql.ansi.enabled": "true",
    # Run-time broadcast choice, partition merging and hot-key splitting. Forcing the skew split
    # keeps it active when it costs one more exchange further up the plan.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Stored tables of ids and amounts take a third less room than under snappy.
    "spark.sql.parquet.compression.codec": "zstd",
}


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of files or folders, from file-system metadata."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return total


def _bytes(spark: SparkSession, setting: str) -> int:
    """A size among the session's settings, given as a number or with a unit."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(setting))


def prepare(
    spark: SparkSession, *input_paths: str, bytes_per_partition: int = BYTES_PER_SHUFFLE_PARTITION
) -> SparkSession:
    """Apply the settings the plans rely on; give reads and shuffles enough partitions for the input."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    if _bytes(spark, "spark.sql.files.maxPartitionBytes") > BYTES_PER_READ:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(BYTES_PER_READ))
    if input_paths:
        wanted = -(-input_bytes(spark, *input_paths) // bytes_per_partition)
        configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            str(max(wanted, configured)),
        )
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, named by the cluster in ``spark.checkpoint.dir``."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="faremill-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


_passing: list[tuple[SparkSession, str]] = []


def _remove() -> None:
    for spark, folder in _passing:
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the JVM may be gone; the folder is then the cluster's to sweep
            return


def remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Remove a folder of passing results when the driver's Python ends."""
    if not _passing:
        atexit.register(_remove)
    _passing.append((spark, folder))
