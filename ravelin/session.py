"""Session settings and the two ways this package cuts a plan: a checkpoint and a size-checked broadcast."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName("ravelin")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "8192")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (`spark.checkpoint.dir`); a local master without one gets a temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        require_local(context.master)
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ravelin-checkpoint-"))
    return context.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder beside the checkpoints, for data that is written and read back."""
    return f"{shared_dir(spark).rstrip('/')}/ravelin-{name}-{uuid.uuid4().hex}"


def require_local(master: str) -> None:
    """Executors of a cluster cannot see a folder of the driver's machine."""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")


def checkpointed(df: DataFrame) -> DataFrame:
    """Run `df` once into the shared folder and go on from the stored rows."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark `df` for broadcast only when its stored row count is within the bound."""
    stored = checkpointed(df)
    return F.broadcast(stored) if stored.count() <= max_rows else stored
