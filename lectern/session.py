"""Session settings the operators share: the cluster's folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder named by the cluster; a temporary one only in local mode."""
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="lectern-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
