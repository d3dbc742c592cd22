"""Where intermediate tables go."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder: `spark.checkpoint.dir`, or the one the application set
    with `SparkContext.setCheckpointDir`."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a costly intermediate once and continue from the written table.

    For parsed pages that several branches of a plan read: each branch would parse again.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(spark: SparkSession) -> None:
    """Ask the driver to collect plans that are done with. Their shuffle files stay on the executors' disks until it does, and
    planning that follows lets its heap grow instead of reusing what they held; a driver with little to do collects late."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
