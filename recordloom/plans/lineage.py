"""Cutting lineage through storage that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEAN = "spark.cleaner.referenceTracking.cleanCheckpoints"


def checkpoint_folder(spark: SparkSession) -> None:
    """Make sure that checkpoint() has a folder.

    A cluster names a shared folder in ``spark.checkpoint.dir``; it is used as
    it is. Only where neither that setting nor a folder is there, and Spark runs
    on one machine, does the session get a temporary one: executors elsewhere
    couldn't read it. Spark deletes a checkpoint once nothing refers to it any
    more, unless the session's own settings say otherwise.
    """
    context = spark.sparkContext
    settings = context._jsc.sc().conf()
    if not settings.contains(_CLEAN):
        settings.set(_CLEAN, "true")
    if context.getCheckpointDir():
        return
    named = context.getConf().get("spark.checkpoint.dir")
    if not named and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="recordloom-"))


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and read from there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt over all cores by a key, before work that costs much a row: files of few row groups would leave it to as many tasks."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder in the shared one, deleted at the end: what is still wanted of it must have been cut by then."""
    checkpoint_folder(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        delete(spark, folder)
