"""Session helpers.

The library never builds a cluster session itself: callers pass theirs. The
helpers here are for tests and the benchmark (``local_session``) and for
finding the shared scratch folder a job may write intermediate tables to.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings every session we create starts from.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "shelfroll") -> SparkSession:
    """A ``local[cores]`` session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if not SparkConf().get("spark.checkpoint.dir", ""):  # one machine: its temporary folder is shared
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shelfroll-ckpt-"))
    builder = builder.config("spark.driver.memory", os.environ.get("SHELFROLL_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which the driver and every executor share; an error where it is unset."""
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"
