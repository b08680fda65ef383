"""Session settings, the shared scratch folder, and tables written to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.ui.enabled": "false",
}

# Rows up to which a measured join side is broadcast: far below what an executor holds for rows of a few columns.
BROADCAST_ROWS = 1_000_000

# Bytes on disk, compressed, up to which a measured join side is broadcast: some hundred MB in memory.
BROADCAST_BYTES = 16 << 20

_local_fallback: str | None = None


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A machine-local folder is used only under a local master, where driver and executors are one process.
    """
    global _local_fallback
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    if _local_fallback is None:
        _local_fallback = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _local_fallback, ignore_errors=True)
    return _local_fallback


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path (not yet created) below the shared folder."""
    return f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write ``df`` as a parquet table in the shared folder; return it re-read, with its row count.

    Unlike a cached frame the table outlives a lost executor, ends the lineage, and has a known size, so
    Catalyst broadcasts it only when it is under ``spark.sql.autoBroadcastJoinThreshold``. The count is
    observed during the write, without a second job.
    """
    table, rows, _ = _written(df, label)
    return table, rows


def _written(df: DataFrame, label: str) -> tuple[DataFrame, int, str]:
    path = fresh_dir(df.sparkSession, label)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["n"], path


def measured_side(df: DataFrame, label: str) -> DataFrame:
    """A join side that is expected to be small, written out and measured before it is used.

    Up to ``BROADCAST_ROWS`` rows and ``BROADCAST_BYTES`` bytes it is marked for broadcast, so the other side is not
    shuffled at all; beyond that it is marked for a merge join, which AQE splits at skewed keys.
    """
    table, rows, path = _written(df, label)
    context = df.sparkSession.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return F.broadcast(table) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else table.hint("merge")
