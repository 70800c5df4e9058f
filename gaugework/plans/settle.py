"""Reliable materialisation points."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's shared checkpoint folder, as ``spark.checkpoint.dir`` names it; an error if none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def use_own_folder_if_local(spark: SparkSession) -> None:
    """For entry points and tests: a local session without ``spark.checkpoint.dir`` gets a folder of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None and not spark.conf.get("spark.checkpoint.dir", None) and context.master.startswith("local") and not context.master.startswith("local-cluster"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the session's shared checkpoint folder and read it back.

    Used where two branches of one plan must see the same physical placement, or where an
    iteration would otherwise grow its lineage.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder beside the session's checkpoints, for stream stores and state."""
    import uuid

    return f"{checkpoint_folder(spark)}/{label}-{uuid.uuid4().hex}"
