"""Session construction and the shared working folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(HDFS, S3, ABFS ...).  Only when it is unset -- local runs and tests -- do we
pick a folder of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  AQE re-plans joins at run
# time (broadcast conversion, skew splitting, partition coalescing).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "4096",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


# Settings of the streaming jobs: keyed state off the JVM heap.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def scale_conf(input_bytes: int, executor_cores: int, executors: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle and split sizing for a given input volume and cluster.

    Starts with enough shuffle partitions that each holds about
    ``target_partition_bytes`` of the input (never fewer than twice the
    cores), and lets AQE coalesce small ones and split skewed ones at run time.
    Example: 100 TB on 1000 executors x 8 cores -> about 373,000 shuffle partitions.
    """
    cores = max(1, executor_cores * executors)
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(target_partition_bytes // 8),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def build_session(app: str = "driftlog", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("DRIFTLOG_DRIVER_MEM", "16g"))
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


@contextmanager
def conf_set(spark: SparkSession, values: dict[str, str]):
    """SQL settings for the length of a ``with`` block."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can see; honours ``spark.checkpoint.dir``.

    Picks a folder of its own only in a local session without that setting;
    on a cluster it raises, because a machine-local folder would be read back
    incomplete.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        sc = None
    if sc is not None:
        root = root or sc.getCheckpointDir()
        if not root:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            root = tempfile.mkdtemp(prefix="driftlog-ckpt-")
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return root.rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared folder; ``unique`` appends a fresh run id."""
    root = shared_root(spark)
    tail = "/".join(p.strip("/") for p in parts if p)
    path = f"{root}/driftlog/{tail}" if tail else f"{root}/driftlog"
    if unique:
        path = f"{path}/run-{uuid.uuid4().hex[:12]}"
    return path


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this package has written, on whatever file system it is."""
    files, p = _hadoop_path(spark, path)
    files.delete(p, True)


def numbered_folders(spark: SparkSession, root: str, key: str) -> list[int]:
    """``N`` of every complete folder ``root/key=N`` (one with a ``_SUCCESS`` mark), ascending."""
    files, p = _hadoop_path(spark, root)
    if not files.exists(p):
        return []
    found = []
    for status in files.listStatus(p):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{key}="):
            mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if files.exists(mark):
                found.append(int(name[len(key) + 1:]))
    return sorted(found)


def folder_state(spark: SparkSession, path: str) -> tuple[int, int]:
    """``(milliseconds since 1970 of its last change, bytes)`` of a complete folder."""
    files, p = _hadoop_path(spark, path)
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")
    return files.getFileStatus(mark).getModificationTime(), files.getContentSummary(p).getLength()


def publish_folder(spark: SparkSession, written: str, final: str) -> None:
    """Give a complete folder its final name in one step."""
    files, source = _hadoop_path(spark, written)
    _, target = _hadoop_path(spark, final)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"{written} could not become {final}")


def make_folder(spark: SparkSession, path: str) -> None:
    files, p = _hadoop_path(spark, path)
    files.mkdirs(p)
