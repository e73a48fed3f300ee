"""Session construction and the shared working folder.

Everything the library writes (reload targets, backups, landed documents) goes below the folder the cluster names in
``spark.checkpoint.dir``. That folder is shared by all executors, so a lost
executor never takes written data with it. A private folder is only created
when the setting is absent, which is the case in local tests.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
#: For ``settings``: a job's shuffle files leave the disk when it ends, not when the driver's memory is next cleaned.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def build_session(
    master: str = "local[*]",
    app_name: str = "tillroll",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings every job here relies on.

    * session time zone UTC: timestamps without offset are read as UTC and
      compare equal across engines;
    * ANSI mode on (Spark 4 default): overflowing casts raise instead of
      wrapping, which the typed load depends on;
    * adaptive execution with partition coalescing and skew-join splitting;
    * the web UI off: batch jobs need no server.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # the shared folder is resolved by the first job that writes
    return spark


def ensure_shared_dir(spark: SparkSession) -> str:
    """Return the cluster's shared folder; create a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get(_CHECKPOINT_KEY, None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        # a machine-local folder would vanish with the executor that wrote it
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder shared by all executors")
    # Unset in a local run (tests): a private folder is enough.
    local = tempfile.mkdtemp(prefix="tillroll-shared-")
    sc.setCheckpointDir(local)
    # setCheckpointDir creates a uuid sub-folder; report the one in use.
    return (sc.getCheckpointDir() or local).rstrip("/")


def scale_settings(input_bytes: int, total_cores: int,
                   target_partition_bytes: int = 256 << 20,
                   max_shuffle_partitions: int = 100_000) -> dict[str, str]:
    """Settings for a job that reads ``input_bytes`` on ``total_cores`` cores.

    * scan splits of ``target_partition_bytes`` (parquet row groups permitting);
    * an initial shuffle partition count that keeps each shuffle partition
      near the target size even if a stage's output is as large as its input,
      never fewer than two waves of tasks and capped (mappers x reducers
      fetches grow quadratically; beyond the cap a partition spills rather
      than multiplying fetches); adaptive execution then coalesces small
      partitions and splits skewed ones at run time;
    * skew thresholds expressed in the same partition size.
    The caller applies them with ``SparkSession.builder.config`` or
    ``spark.conf.set`` before the job runs.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    parts = min(parts, max(max_shuffle_partitions, 2 * total_cores))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared folder; ``unique`` appends a fresh suffix."""
    base = ensure_shared_dir(spark)
    tail = "/".join(p.strip("/") for p in parts if p)
    if unique:
        tail = f"{tail}-{uuid.uuid4().hex[:12]}" if tail else uuid.uuid4().hex[:12]
    return f"{base}/{tail}" if tail else base


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the jobs that run inside; a lazy result is planned with those of its own time."""
    before = {key: spark.conf.get(key) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
