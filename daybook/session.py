"""Session set-up, job life cycle and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
}

SHUFFLE_PARTITION_BYTES = 200 * 1024 * 1024
MIN_SHUFFLE_PARTITIONS = 200
#: Spark takes an input without statistics to be larger than this.
UNKNOWN_BYTES = 1 << 60

CHECKPOINT_DIR = "spark.checkpoint.dir"
SPLIT_SKEW = "spark.sql.adaptive.forceOptimizeSkewedJoin"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
DYNAMIC_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
#: The JVM never compiles a method of more bytes than this; it interprets each call of it.
COMPILED_METHOD_BYTES = 8000


def shuffle_partitions(input_bytes: int) -> int:
    """Shuffle partitions for an input, so that one partition fits a task's memory.

    AQE merges partitions that turn out small, but it never adds any for a plain join.
    """
    return max(MIN_SHUFFLE_PARTITIONS, -(-input_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(
    app_name: str, master: str | None = None, input_bytes: int | None = None, **settings: str
) -> SparkSession:
    """A session with the settings the jobs rely on, sized for its input if that is given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = {}
    if input_bytes is not None:
        sized["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    for key, value in {**SESSION_DEFAULTS, **sized, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def run_job(app_name: str, job: Callable[[SparkSession], T], **settings: str) -> T:
    """Open a session, run the job, and clear up and stop the session whatever happens."""
    spark = build_session(app_name, **settings)
    try:
        return job(spark)
    finally:
        try:
            clear_workspaces(spark)
        finally:
            spark.stop()


#: What this process made and has not dropped yet.
_databases: set[str] = set()
_folders: set[str] = set()


def workspace(spark: SparkSession, label: str) -> str:
    """A new, unused folder path for staged data; see :func:`clear_workspaces`.

    It lies in the shared folder named by ``spark.checkpoint.dir``, so that every
    executor can read what another one wrote. Only a local session without that
    setting gets a temporary folder of its own.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="daybook-")
    folder = f"{base.rstrip('/')}/daybook/{label}-{uuid.uuid4().hex[:12]}"
    _folders.add(folder)
    return folder


def scratch_database(spark: SparkSession, label: str) -> str:
    """Create a database of its own under the workspace and return its name."""
    name = f"daybook_{label}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{workspace(spark, label)}'")
    _databases.add(name)
    return name


def drop_scratch_databases(spark: SparkSession) -> None:
    """Drop the databases that :func:`scratch_database` made in this process, and no other."""
    while _databases:
        spark.sql(f"DROP DATABASE IF EXISTS {_databases.pop()} CASCADE")


def clear_workspaces(spark: SparkSession) -> None:
    """Drop this process's scratch databases and delete its workspace folders.

    Frames that read from them cannot be used any more, so this ends a job.
    """
    drop_scratch_databases(spark)
    while _folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(_folders.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def estimated_bytes(*frames: DataFrame) -> int:
    """Bytes that the frames read, by Spark's statistics of their inputs: no job is run.

    Partitions that a filter prunes do not count, inputs of unknown size count nothing.
    """
    total = 0
    for df in frames:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
        total += sum(s for s in sizes if s < UNKNOWN_BYTES)
    return total


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise the session's shuffle partitions to what an input needs; never lowers them."""
    have = int(spark.conf.get(SHUFFLE_PARTITIONS))
    need = max(have, -(-input_bytes // SHUFFLE_PARTITION_BYTES))
    if need > have:
        spark.conf.set(SHUFFLE_PARTITIONS, str(need))
    return need


def ensure_dynamic_overwrite(spark: SparkSession) -> None:
    """Partition replacement relies on the session's dynamic overwrite mode.

    ``insertInto`` takes the mode from the session only (a writer option is not
    honoured for catalog tables), so every session that maintains tables has it on.
    """
    if spark.conf.get(DYNAMIC_OVERWRITE).lower() != "dynamic":
        spark.conf.set(DYNAMIC_OVERWRITE, "dynamic")


def ensure_skew_splits(spark: SparkSession) -> None:
    """Let AQE split a skewed join even if the next join on the key then shuffles again."""
    if spark.conf.get(SPLIT_SKEW).lower() != "true":
        spark.conf.set(SPLIT_SKEW, "true")


def ensure_bucket_joins(spark: SparkSession) -> None:
    """Let tables in buckets of one key be joined on it and further columns without a shuffle."""
    if spark.conf.get(ALL_KEYS).lower() != "false":
        spark.conf.set(ALL_KEYS, "false")


def ensure_compiled_methods(spark: SparkSession) -> None:
    """Let no stage of many columns become one method that the JVM interprets row by row.

    Its operators are then generated one by one, in methods short enough to be compiled.
    """
    if int(spark.conf.get(HUGE_METHOD)) > COMPILED_METHOD_BYTES:
        spark.conf.set(HUGE_METHOD, str(COMPILED_METHOD_BYTES))
