"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])

# Runtime settings every operator was planned with.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more shuffle later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cores: str = "8", app: str = "ledgerloom", **extra: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else started."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package, from a file system that they share."""
    paths = spark.sparkContext.environment
    if ROOT not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(filter(None, [paths.get("PYTHONPATH"), ROOT]))


def sizing(input_bytes: int, cores: int, partition_bytes: int = 200 << 20) -> dict[str, str]:
    """Partition settings for a volume of input.

    Shuffles start with partitions of about ``partition_bytes``, at least two per core,
    and adaptive execution merges the small ones again.
    """
    partitions = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors can reach.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
    return context.getCheckpointDir().rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for one run."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
