"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on; all can be set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when the split costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows are whole texts: a batch of the default 10,000 takes much of a worker's memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return pin_splits(spark)


def pin_splits(spark: SparkSession) -> SparkSession:
    """Keep the splits of a table as they are when executors come or go.

    Spark sizes them from the cores it has when it plans a job. Row numbers are places in the
    splits, so the number first seen stays; a number the session has set is kept.
    """
    pinned = "spark.sql.files.minPartitionNum"
    if spark.conf.get(pinned, None) is None:
        cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
        spark.conf.set(pinned, cores or str(spark.sparkContext.defaultParallelism))
    return spark


def build(app_name: str = "tablehandoff", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    static = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}
    for key, value in {**RUNTIME_CONF, **static, **extra}.items():
        builder = builder.config(key, value)
    return pin_splits(builder.getOrCreate())


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without the
    setting gets a folder of its own, removed at exit; a cluster session without it is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current is not None:
        return current
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    folder = tempfile.mkdtemp(prefix="tablehandoff-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return folder


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, for tables a job writes on its way."""
    base = checkpoint_folder(spark).rstrip("/")
    return f"{base}/tablehandoff/{name}-{uuid.uuid4().hex}"


def local_cores(default: int = 8) -> str:
    return f"local[{os.environ.get('BENCH_CPUS', default)}]"
