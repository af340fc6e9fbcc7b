"""Shared scratch space for lineage cuts and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the checkpoint folder of the session. Only a local session without
    one gets a temporary folder of its own: on a cluster a machine-local folder
    would be invisible to the other machines.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tristrata-")
    context.setCheckpointDir(folder)
    return folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path inside the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
