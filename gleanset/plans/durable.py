"""Cutting lineage in storage that outlives an executor."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints, or the one the session has set.

    Where both are unset, a session on this one machine gets a temporary folder; a
    cluster session is refused, since a folder of one machine is no use there.
    """
    context = spark.sparkContext
    named = context.getConf().get(CHECKPOINT_SETTING) or spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named
    current = context.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[[^,\]]*(,[^\]]*)?\])?", context.master):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    return tempfile.mkdtemp(prefix="gleanset-")


def durable(frame: DataFrame) -> DataFrame:
    """Compute the frame now and read it back from reliable storage from then on."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return f"{context.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
