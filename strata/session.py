"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: event-time functions (year, month, hour) are evaluated in
# UTC, AQE re-plans joins / partition counts from runtime sizes, ANSI stays on (all casts
# in this package are try_* casts).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Starting points for a large cluster (hundreds of executors, tens of TB per job). AQE
# coalesces shuffle partitions downwards from the initial number towards the advisory size
# and splits skewed ones; the scan split size keeps a task's input in memory with room for
# the partial aggregation buffers.
CLUSTER_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.files.maxRecordsPerFile": "20000000",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}


def initial_partitions(input_bytes: int) -> int:
    """Shuffle partitions that hold about an advisory size each if all input is shuffled; AQE merges from there."""
    return max(200, -(-input_bytes // (256 << 20)))


def build_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    cluster: bool = False,
    input_bytes: int | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the package's base settings.

    ``master`` is left to spark-submit when ``None``. ``cluster`` adds ``CLUSTER_CONF``
    and needs ``input_bytes`` (of the largest table a job reads) or ``shuffle_partitions``: AQE only merges
    an aggregate's partitions, so their first number has to grow with the input.
    ``shuffle_partitions`` should be sized so one partition is ~128-256 MB of shuffle data
    at the target scale; AQE coalesces downwards from it at runtime.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = dict(BASE_CONF)
    if cluster:
        if not input_bytes and not shuffle_partitions:
            raise ValueError("a cluster session needs input_bytes or shuffle_partitions")
        merged.update(CLUSTER_CONF)
    if input_bytes:
        # AQE merges from here; operators that deal rows into buckets of their own take the same number
        for name in ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.shuffle.partitions"):
            merged[name] = str(initial_partitions(input_bytes))
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for k, v in merged.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def small_splits(spark: SparkSession, most: str = "32m") -> Iterator[None]:
    """Scans of jobs that run inside read at most ``most`` a task, for jobs that sort what a task reads: packed columns
    unfold to some ten times their size."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    own = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    spark.conf.set(name, str(min(own(before), own(most))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    The setting is read from the session. Only a local-mode session (tests, a laptop) gets
    a fresh temporary folder when it is unset; on a cluster a missing setting is an error,
    because a machine-local folder does not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared, fault-tolerant folder"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (for written intermediate tables)."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
