"""Session settings shared by the entry point, the bench and the tests."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning: small sides are broadcast only after Spark has measured
# them, and hot join keys are split even where that costs one more shuffle.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}
# A task of the feature tables holds its partition several times, in the sorts and hash tables of one stage: most bytes of a
# partition, and shuffle partitions before small ones are put together.
PARTITION_MB, PARTITIONS = 16, 600
# Tables that lie by the loan are joined on the loan and more without being moved again.
JOINED_IN_PLACE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
# The shuffle files of a query are deleted when it has ended, not when the driver happens to collect garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune_tables(spark: SparkSession) -> SparkSession:
    """``tune``, and partitions small enough for several sorts in a task, unless the cluster's are smaller."""
    for name, value in JOINED_IN_PLACE.items():
        tune(spark).conf.set(name, value)
    size, first = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(size, "64m"))
    if now > PARTITION_MB << 20:
        spark.conf.set(size, f"{PARTITION_MB}m")
        spark.conf.set(first, str(max(PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Set the options the plans rely on; everything else stays the cluster's."""
    for name, value in ADAPTIVE.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "8", app: str = "riskloom") -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("RISKLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")  # a checkpoint goes with its table
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")  # small data, few cores
    )
    for name, value in ADAPTIVE.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster the
    setting has to be there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="riskloom-")


def computed(df: DataFrame) -> DataFrame:
    """The table computed once and kept in the shared folder; its lineage ends there.

    A lost executor then costs a re-read, and nothing is cached under a plan
    that could go stale.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """The table written as Parquet to a folder of its own in the shared one; the shuffle files that it took go at once.

    For wide tables that take much disk on the way; the folder stays, as the table is read from it.
    """
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        build().write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.parquet(path)


def _file_system(spark: SparkSession, path: str):
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), own


def exists(spark: SparkSession, path: str) -> bool:
    files, own = _file_system(spark, path)
    return files.exists(own)


def file_states(spark: SparkSession, paths: list[str]) -> list[str]:
    """Each file with its size and time."""
    out = []
    for path in paths:
        files, own = _file_system(spark, path)
        status = files.getFileStatus(own)
        out.append(f"{path} {status.getLen()} {status.getModificationTime()}")
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    files, own = _file_system(spark, path)
    files.delete(own, True)
