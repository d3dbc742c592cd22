"""Sinks. Sentinel texts are put in here, not earlier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork import lexicons as lx
from gleanwork.sources import batches


def with_sentinels(df: DataFrame, sentinels: Mapping[str, str]) -> DataFrame:
    return df.na.fill({c: s for c, s in sentinels.items() if c in df.columns})


def select_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Exactly the listed columns in order; extra columns are dropped, absent ones are null."""
    return df.select(*[F.col(f) if f in df.columns else F.lit(None).cast("string").alias(f) for f in fields])


def write_csv(
    df: DataFrame, path: str, fields: Sequence[str], mode: str = "overwrite", order_by: Sequence[str | Column] = ()
) -> None:
    """With `order_by` every part file holds a range of the order, and parts follow it by name."""
    rows = df.orderBy(*order_by) if order_by else df
    select_fields(rows, fields).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON Lines: one record per line instead of one array per file."""
    df.write.mode(mode).json(path)


def write_cohort(df: DataFrame, root: str, name: str) -> None:
    """One Parquet directory per cohort."""
    df.write.mode("overwrite").parquet(f"{root}/{name}")


def write_run(df: DataFrame, path: str, run_ts: str, mode: str = "append") -> None:
    """Append a run, stamped and partitioned by its date."""
    ts = F.lit(run_ts).cast("timestamp")
    stamped = df.withColumn("run_ts", ts).withColumn("run_date", F.to_date(ts))
    stamped.write.mode(mode).partitionBy("run_date").parquet(path)


def append_rows(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Append-only results; a batch written again under its name counts once. Read by `readers.read_rows`."""
    batches.append_batch(df, path, batch)


def append_ledger(df: DataFrame, path: str, url: str, status: str, run_id: str, batch: str | None = None) -> None:
    """One ledger row per fetched URL; counters are derived from it by aggregation. A run that is repeated replaces its marks; one that
    marks in several steps names them by `batch`."""
    rows = df.select(
        F.col(url).alias("url"), F.col(status).alias("status"),
        F.lit(run_id).alias("run_id"), F.current_timestamp().alias("ts"),
    )
    batches.append_batch(rows, path, batch or run_id)


def write_reports(df: DataFrame, path: str, key: str, title: str, body: str) -> None:
    """One text directory per key, with one file: a heading, a rule, the body.

    The work is in the number of files and not in their bytes, so the number of tasks is fixed: adaptive execution would join small
    parts until one task writes all files. Each task moves its own files into place; a run that dies leaves no `_SUCCESS`.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heading = F.concat(F.lit(lx.REPORT_HEADING), F.col(title))
    text = F.concat(heading, F.lit("\n" + "=" * 80 + "\n\n"), F.col(body))
    files = df.select(F.col(key), text.alias("value")).repartition(parts, key).write.mode("overwrite")
    files.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(key).text(path)
