"""SparkSession settings the library expects.

The library never relies on the session time zone (every date is computed
with arithmetic on epoch values), but UTC is still pinned so that displayed
timestamps read the same everywhere.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which shuffle files go when their query ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Raw snapshots written by pandas hold nanosecond timestamps and byte strings.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.parquet.binaryAsString": "false",
    # A rewrite of one day's snapshot replaces only that day's partition.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # Per-call Python stack capture for error context costs a JVM round trip
    # per function call while a plan is built; errors still carry the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 shuffle_fraction: float = 0.3, least_bytes: int = 256 << 20,
                 shuffle_blocks: float = 1e9) -> dict:
    """Settings sized to the data for a cluster run.

    Scan splits and shuffle partitions of the largest shuffle
    (``input_bytes * shuffle_fraction``: raw rows after projection and
    map-side combine) have the same size, 256 MB or whatever more keeps
    map tasks x shuffle partitions at about ``shuffle_blocks``: beyond that,
    fetching blocks of under a KB and tracking them costs more than the data.
    There are never fewer partitions than twice the cores; AQE merges those
    of small shuffles and splits skewed join partitions. E.g. 100 TB on
    1000 x 8 cores gives 1.7 GB each: ~58,000 map tasks and ~17,000
    partitions. A partition of that size is sorted and aggregated with
    spilling in an executor of 8 cores and 32 GB or more. Map output is
    assumed to outlive its executor (an external shuffle service);
    without one a lost executor's map tasks run again.
    """
    cores = executors * cores_per_executor
    partition_bytes = max(least_bytes, math.ceil(input_bytes * math.sqrt(shuffle_fraction / shuffle_blocks)))
    partitions = max(2 * cores, int(input_bytes * shuffle_fraction // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        # A side is broadcast only when its estimated (static) or measured
        # (AQE) size is below this; the catalogue projection of a large
        # service fits, fact tables never do.
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        # Stragglers on a large cluster: re-launch slow tasks elsewhere.
        "spark.speculation": "true",
        # Lost executors: retry shuffle fetches and tasks before failing a stage.
        "spark.shuffle.io.maxRetries": "10",
        "spark.task.maxFailures": "8",
    }


def build_session(master: str | None = None, app: str = "reelstat",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``shuffle_partitions`` should be sized so one shuffle partition holds
    roughly 128-256 MB at the target scale; tests use the core count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used
    as it is; a machine-local fallback is only created for ``local[...]``
    masters (tests, single-machine runs). A cluster without the setting is a
    configuration error: a local folder would not survive a lost executor.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    local = tempfile.mkdtemp(prefix="reelstat-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return local


def written_once(df: DataFrame, purpose: str) -> DataFrame:
    """The frame, written under the shared checkpoint folder and read back.

    For a result that several branches of a plan read: it is computed once,
    and a lost executor re-reads it rather than its sources.
    """
    return _written_to(df, _new_folder(df.sparkSession, purpose))


def _new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _written_to(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept_meanwhile() -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``written_once`` for the block alone: the tables that it wrote are removed at the end."""
    folders = []

    def keep(df: DataFrame, purpose: str) -> DataFrame:
        folders.append((df.sparkSession, path := _new_folder(df.sparkSession, purpose)))
        return _written_to(df, path)

    try:
        yield keep
    finally:
        for spark, path in folders:
            drop_folder(spark, path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Removes a written intermediate table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries within go as soon as each has ended, not at the driver's next garbage collection."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
