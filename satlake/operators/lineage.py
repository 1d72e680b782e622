"""Cutting lineage in a folder that all executors share, so that a lost executor loses no more than its tasks."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a local session gets a folder of its own; on a cluster, whose executors
    can't read the driver's folders, it is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="satlake-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
