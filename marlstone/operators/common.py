"""Cutting lineage, and the size of Arrow batches."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only where the session names none and runs on one machine, a temporary folder is made.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='marlstone-')}"
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches small enough for rows that hold whole records, for the queries that run from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def settled(df: DataFrame) -> DataFrame:
    """``df`` checkpointed to the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
