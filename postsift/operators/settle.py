"""Compute a table once and keep it where every executor can read it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str | None:
    """The folder for checkpoints: the one in use, else the one the cluster names, else None."""
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current is not None:
            spark.sparkContext.setCheckpointDir(current)
    return current


def settle(frame: DataFrame) -> DataFrame:
    """Write `frame` to the checkpoint folder and go on from there.

    Later steps neither repeat its computation nor depend on executors that may be lost.
    """
    if checkpoint_folder(frame.sparkSession) is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return frame.checkpoint(eager=True)
