"""Session helpers: a local session for tests/bench and the checkpoint folder."""
from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the library's plans are tuned for.  They change how Spark
# executes (adaptive re-planning, skew splitting), never what it computes, so
# ``configure`` applies them to any session the library is handed.
PERFORMANCE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when that costs a shuffle downstream
    # (a key may hold a third of the rows)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM interprets methods of more bytecode than this: a stage of wide rows (CSV
    # extracts) runs several times faster operator by operator, in methods that are compiled
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# Local sessions (tests, bench) also pin the session time zone.
SESSION_DEFAULTS = {**PERFORMANCE_DEFAULTS, "spark.sql.session.timeZone": "UTC"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cargoline") -> SparkSession:
    """A single-JVM session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CARGOLINE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply PERFORMANCE_DEFAULTS (execution-only settings) to the session."""
    for key, value in PERFORMANCE_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster).  Only a local master
    without that setting -- tests and the bench -- gets a fresh scratch folder, so
    reruns never clear or reuse an old one.  On a cluster an unset folder is an error:
    a scratch folder of one machine is not seen by the others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    if not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="cargoline-ckpt-", dir=os.environ.get("CARGOLINE_SCRATCH", "/tmp"))
    sc.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def written_once(df: DataFrame, label: str = "shared", partition_by: str | None = None) -> DataFrame:
    """``df`` written as parquet under the checkpoint folder and read back: computed once,
    however often it is used, and a lost executor rereads files.  ``partition_by`` gives a
    column its own folders, so that a filter on it reads only those."""
    path = new_folder(df.sparkSession, label)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
