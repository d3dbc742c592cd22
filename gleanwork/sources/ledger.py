"""The crawl ledger as one snapshot and the marks since, so that a run's cost follows its own size and not that of the crawl.

Marks are batches (`sources.batches`), one per run. `compact` folds them into a snapshot of one row per URL, a table bucketed and sorted by a hash of
the URL; a row in `snapshots` then names its folder and the runs it covers. Readers take the newest snapshot and the runs that it
does not cover. The frontier joins its requests to the snapshot's buckets: only the requests move.

A run that is in a snapshot has ended; marks written later under its name are not read. An attempt to compact that ended early is never seen.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from gleanwork import schemas
from gleanwork.operators.joins import members
from gleanwork.sources import batches, writers

_SNAPSHOT = "url STRING, status STRING, run_id STRING, ts TIMESTAMP, done BOOLEAN, attempts LONG"
_STATE = "at LONG, name STRING, buckets INT, covered ARRAY<STRING>"
_DONE = ("completed", "dead")


def _state(spark: SparkSession, path: str) -> tuple[str | None, int, set[str]]:
    """(name, buckets, covered runs) of the newest snapshot."""
    try:
        last = spark.read.schema(_STATE).parquet(f"{path}/snapshots").orderBy(F.desc("at")).first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None, 0, set()
    return last["name"], last["buckets"], set(last["covered"])


def _table(spark: SparkSession, path: str, name: str, buckets: int) -> DataFrame:
    """The snapshot as a bucketed table; its definition is made anew in a session that does not have it."""
    folder = f"{path}/{name}".replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_SNAPSHOT}) USING parquet OPTIONS (path '{folder}') CLUSTERED BY (url) SORTED BY (url) INTO {buckets} BUCKETS")
    return spark.table(name)


def parts(spark: SparkSession, path: str, without: str | None = None) -> tuple[DataFrame | None, DataFrame]:
    """(snapshot, marks of the runs since); `without` leaves out a run, for one that is repeated."""
    name, buckets, covered = _state(spark, path)
    since = [a for run, a in batches.attempts(spark, path).items() if run not in covered and run != without]
    marks = batches.read_attempts(spark, path, since, schemas.CRAWL_LEDGER)
    return (_table(spark, path, name, buckets) if name else None), marks


def _folded(marks: DataFrame) -> DataFrame:
    last = F.max(F.struct("ts", "run_id", "status"))
    rows = marks.groupBy("url").agg(last.alias("last"), F.max(F.col("status").isin(*_DONE)).alias("done"), F.count("*").alias("attempts"))
    return rows.select("url", "last.status", "last.run_id", "last.ts", F.coalesce("done", F.lit(False)).alias("done"), "attempts")


def _merged(snapshot: DataFrame | None, marks: DataFrame) -> DataFrame:
    """One row per URL. The snapshot stays in its buckets, the marks are brought to them."""
    new = _folded(marks)
    if snapshot is None:
        return new
    n = new.select(F.col("url").alias("u"), F.struct("status", "run_id", "ts").alias("new"), F.col("done").alias("d"), F.col("attempts").alias("a"))
    both = snapshot.withColumn("old", F.struct("status", "run_id", "ts")).join(n, F.col("url") == F.col("u"), "full_outer")
    newer = F.col("u").isNotNull() & (F.col("url").isNull() | (F.col("new.ts") >= F.col("old.ts")))
    last = F.when(newer, F.col("new")).otherwise(F.col("old"))
    return both.select(F.coalesce("url", "u").alias("url"), last["status"].alias("status"), last["run_id"].alias("run_id"), last["ts"].alias("ts"),
                       (F.coalesce("done", F.lit(False)) | F.coalesce("d", F.lit(False))).alias("done"),
                       (F.coalesce("attempts", F.lit(0)) + F.coalesce("a", F.lit(0))).alias("attempts"))


def latest(spark: SparkSession, path: str) -> DataFrame:
    """(url, status, run_id, ts, done, attempts): the last mark of each URL, whether it was ever done, and how often it was marked."""
    return _merged(*parts(spark, path))


def compact(spark: SparkSession, path: str, buckets: int | None = None) -> None:
    """Fold all marks into a new snapshot. The number of buckets is that of the former one, at first the session's shuffle partitions."""
    name, former, covered = _state(spark, path)
    runs = set(batches.attempts(spark, path))
    if runs <= covered:
        return
    buckets = former or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fresh = f"ledger_{uuid.uuid4().hex}"
    rows = _merged(*parts(spark, path)).repartition(buckets, "url")
    rows.write.format("parquet").option("path", f"{path}/{fresh}").bucketBy(buckets, "url").sortBy("url").saveAsTable(fresh)
    row = spark.createDataFrame([(time.time_ns(), fresh, buckets, sorted(covered | runs))], _STATE)
    row.coalesce(1).write.mode("append").parquet(f"{path}/snapshots")


def frontier(spark: SparkSession, path: str, requests: DataFrame, key: str = "url", without: str | None = None) -> DataFrame:
    """The requests whose URL was never completed nor found dead. A missing URL is never done."""
    snapshot, marks = parts(spark, path, without)
    done = members(marks.filter(F.col("status").isin(*_DONE)), requests, "url", key).select(F.col("url").alias("__since")).distinct()
    todo = requests.join(done, F.col(key) == F.col("__since"), "left_anti")
    if snapshot is None:
        return todo
    return todo.join(snapshot.filter("done").select(F.col("url").alias("__done")), F.col(key) == F.col("__done"), "left_anti")


def run_once(spark: SparkSession, path: str, out: str, requests: DataFrame, run_id: str, fetch: Callable[[DataFrame], DataFrame], key: str = "url", compact_every: int = 20) -> None:
    """One run: what is not done is fetched, saved and marked; repeated under its name it replaces what it wrote. After `compact_every` runs
    the marks are folded, so that no run reads more than that many."""
    todo = frontier(spark, path, requests, key, without=run_id)
    attempt = batches.append_batch(fetch(todo), out, run_id)
    saved = batches.read_attempts(spark, out, [attempt])
    writers.append_ledger(saved, path, key, "status", run_id)
    if len(set(batches.attempts(spark, path)) - _state(spark, path)[2]) >= compact_every:
        compact(spark, path)
