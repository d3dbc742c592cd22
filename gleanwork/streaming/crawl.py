"""Periodic, resumable runs. An external scheduler starts them; `availableNow` ends them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleanwork.operators.dedup import keep_first
from gleanwork.operators.joins import frontier, members
from gleanwork.session import staged
from gleanwork.sources import batches
from gleanwork.sources.readers import read_ledger


def stream_files(
    spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000, fmt: str = "parquet"
) -> DataFrame:
    return (
        spark.readStream.schema(schema).format(fmt)
        .option("maxFilesPerTrigger", files_per_batch).load(path)
    )


def first_seen(stream: DataFrame, key: str, event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """Drop keys seen before, across restarts. With an event time and a delay the state is bounded:
    rows later than the delay are dropped, and counted as such in the query's progress."""
    if (event_time is None) != (delay is None):
        raise ValueError("give both an event time and a delay, or neither")
    if event_time is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def append_snapshots(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write each micro-batch as one partition; a replayed batch overwrites its own."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def _fetch_and_mark(
    asked: DataFrame, done: DataFrame, ledger: str, out: str, run_id: str, key: str,
    fetch: Callable[[DataFrame], DataFrame], retry_failed: bool,
) -> None:
    """Fetch what is not done, save it, then mark it; both named by run, so a replay replaces its own."""
    # Only the ledger rows of this batch matter; the ledger itself is filtered, not shuffled,
    # as long as the batch's URLs are few enough to broadcast.
    seen = members(done.select(F.col("url").alias(key), "status"), asked, key)
    path = f"{out}/batch_id={run_id}"
    fetch(frontier(asked, seen, key, retry_failed)).write.mode("overwrite").parquet(path)
    saved = asked.sparkSession.read.parquet(path)
    marks = saved.select(
        F.col(key).alias("url"), "status", F.lit(run_id).alias("run_id"), F.current_timestamp().alias("ts"),
    )
    batches.append_batch(marks, ledger, run_id)


def latest_status(ledger: DataFrame) -> DataFrame:
    """(url, status, attempts) by the last mark of each URL; of marks of one time that of the larger run id."""
    last = F.max_by("status", F.struct("ts", "run_id", "status"))
    return ledger.groupBy("url").agg(last.alias("status"), F.count("*").alias("attempts"))


def retry_failed_urls(
    spark: SparkSession, ledger: str, out: str, key: str, fetch: Callable[[DataFrame], DataFrame],
    max_attempts: int | None = None,
) -> None:
    """Ask once more for the URLs whose last status is failed, whether or not new requests arrive."""
    marks = read_ledger(spark, ledger)
    failed = latest_status(marks).filter("status = 'failed'")
    if max_attempts is not None:
        failed = failed.filter(F.col("attempts") < max_attempts)
    runs = marks.filter(F.col("run_id").startswith("retry-")).agg(F.count_distinct("run_id").alias("n")).first()["n"]
    asked = staged(failed.select(F.col("url").alias(key)), "retries")
    if not asked.isEmpty():
        _fetch_and_mark(asked, marks.filter("status <> 'failed'"), ledger, out, f"retry-{runs}", key, fetch, True)


def crawl_batches(
    requests: DataFrame, ledger: str, out: str, checkpoint: str, key: str, order: str,
    fetch: Callable[[DataFrame], DataFrame], retry_failed: bool = True, max_attempts: int | None = None,
) -> StreamingQuery:
    """Failed URLs of earlier runs first, then for each micro-batch: frontier against the ledger,
    fetch, save, and mark in the ledger.

    The set of done URLs lives in the ledger table, not in streaming state, so it is as large as
    the crawl without growing the executors' memory. `fetch` maps requests to rows with a
    `status` column.
    """
    if retry_failed:
        retry_failed_urls(requests.sparkSession, ledger, out, key, fetch, max_attempts)

    def run(batch: DataFrame, batch_id: int) -> None:
        # The ledger as it was before this batch, so that a replay sees the same frontier.
        # Runs outside this stream have names instead of numbers and always count.
        earlier = F.coalesce(F.col("run_id").try_cast("bigint"), F.lit(-1)) < batch_id
        done = read_ledger(batch.sparkSession, ledger).filter(earlier)
        _fetch_and_mark(keep_first(batch, [key], [order]), done, ledger, out, str(batch_id), key, fetch, retry_failed)

    return (
        requests.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def status_counts(stream: DataFrame, status: str, sink: str, checkpoint: str, mode: str = "complete") -> StreamingQuery:
    """Running counts per status; state is one counter per status.

    mode="complete" rewrites all counters with every batch; mode="update" writes those that a batch changed, under the batch's number, so a
    replayed batch overwrites its own. Either is read by `read_counts`.
    """
    if mode not in ("complete", "update"):
        raise ValueError("mode must be 'complete' or 'update'")

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(sink if mode == "complete" else f"{sink}/batch_id={batch_id}")

    counts = stream.groupBy(status).agg(F.count("*").alias("n"))
    return (
        counts.writeStream.outputMode(mode).foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_counts(spark: SparkSession, sink: str, status: str = "status") -> DataFrame:
    """(status, n): the last count of each status, in either mode."""
    found = spark.read.parquet(sink)
    if "batch_id" not in found.columns:
        return found
    return found.groupBy(status).agg(F.max_by("n", "batch_id").alias("n"))
