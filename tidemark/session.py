"""Session settings, and the small tables that are pinned between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A pinned table is broadcast only when it is counted and found no larger than this many rows.
# Pinned tables hold keys and a few numbers, so this stays near 20 MB.
BROADCAST_ROWS = 200_000

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on. On a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a
    temporary folder.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def pin(df: DataFrame) -> DataFrame:
    """Compute a small derived table once and cut its lineage with a reliable checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame) -> DataFrame:
    """Write an intermediate table of any size to the shared folder and read it back.

    Used where several aggregates and the rows themselves come from one costly plan. Unlike a
    checkpoint the copy is columnar, so each of them reads only its columns. Its folder belongs to
    the checkpoint folder and is cleared with it.
    """
    path = f"{shared_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(pinned: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a pinned table for broadcast if, and only if, its counted size is within the bound.

    Beyond the bound it is returned as it is, and the join becomes a shuffle join that adaptive
    execution splits where a key is hot.
    """
    return F.broadcast(pinned) if pinned.limit(rows + 1).count() <= rows else pinned
