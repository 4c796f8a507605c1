"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# UTC keeps day buckets stable; AQE sizes shuffles, turns small join sides into
# broadcasts from measured sizes and splits skewed partitions at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints of a run go with the frames that used them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # A plan names its partition filters whole: 100 characters hold two dates only while column numbers are short.
    "spark.sql.maxMetadataStringLength": "1000",
    # Recording a call site for every column expression costs more than planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def sizing(shuffle_bytes: int, cores: int, target_bytes: int = 200 * 1024**2) -> dict[str, str]:
    """Cluster settings for jobs that shuffle about ``shuffle_bytes``.

    The starting number of shuffle partitions is set by volume, so that one fits an
    executor's memory share; AQE merges them again where a later stage is small.
    """
    partitions = max(2 * cores, -(-shuffle_bytes // target_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
    }


def session() -> SparkSession:
    """The cluster's session with this package's defaults; master and resources come from spark-submit."""
    builder = SparkSession.builder.appName("tidemark")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for laptops, tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a temporary folder; on a cluster a
    machine-local folder would be lost with its machine.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(CHECKPOINT_KEY, root)
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared root."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
