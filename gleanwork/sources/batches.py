"""Append-only tables in which a batch counts once, however often it is written.

Data of an attempt goes to a folder of its own, `data/<attempt>`; then one row (batch, attempt, time) is added to `manifest`. Readers take, for each
batch, the last attempt in the manifest and nothing else. An attempt that ended before its manifest row is never seen; a batch that is written
again under its name replaces itself. One writer at a time is assumed for a batch, any number for different ones.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

_MANIFEST = "batch STRING, attempt STRING, at LONG"


def new_attempt() -> str:
    return uuid.uuid4().hex


def folder(path: str, attempt: str) -> str:
    return f"{path}/data/{attempt}"


def write_attempt(df: DataFrame, path: str) -> str:
    """The data of a batch, not yet visible."""
    attempt = new_attempt()
    df.write.parquet(folder(path, attempt))
    return attempt


def commit(spark: SparkSession, path: str, batch: str, attempt: str) -> None:
    row = spark.createDataFrame([(batch, attempt, time.time_ns())], _MANIFEST)
    row.coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def append_batch(df: DataFrame, path: str, batch: str | None = None) -> str:
    """Append the rows as a batch of that name, in place of what the name held before; without a name they are a batch of their own."""
    attempt = write_attempt(df, path)
    commit(df.sparkSession, path, batch or attempt, attempt)
    return attempt


def attempts(spark: SparkSession, path: str) -> dict[str, str]:
    """Batch to attempt, in the order of their last writing; empty before the first batch."""
    try:
        manifest = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
        last = manifest.groupBy("batch").agg(F.max(F.struct("at", "attempt")).alias("last")).select("batch", "last.*").collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return {}
    return {r["batch"]: r["attempt"] for r in sorted(last, key=lambda r: (r["at"], r["attempt"]))}


def read_attempts(spark: SparkSession, path: str, chosen: list[str], schema: str | None = None) -> DataFrame:
    """The rows of some attempts. Without a schema each is read by its own, and what one lacks is null; an attempt may be partitioned."""
    if schema is not None:
        return spark.read.schema(schema).parquet(*[folder(path, a) for a in chosen]) if chosen else spark.createDataFrame([], schema)
    out = spark.read.option("mergeSchema", True).parquet(folder(path, chosen[0]))
    for a in chosen[1:]:
        out = out.unionByName(spark.read.option("mergeSchema", True).parquet(folder(path, a)), allowMissingColumns=True)
    return out


def read_batches(spark: SparkSession, path: str, schema: str | None = None, without: str | None = None) -> DataFrame:
    """All batches, or all but one. Before the first batch a schema is needed."""
    found = attempts(spark, path)
    return read_attempts(spark, path, [a for b, a in found.items() if b != without], schema)
