"""Which periodic run is due: a table of what became of each run, and when the next may start.

A scheduler from outside calls `run_if_due` as often as it likes; runs themselves never wait. A job that completed is due an interval after it
started. One that failed waits `retry_wait` after its end, twice as long after each further failure in a row, `max_wait` at most. A run
that started and was not heard of for `lease` counts as failed at that time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.sources import batches

EVENTS = "job STRING, run_id STRING, state STRING, started TIMESTAMP, at TIMESTAMP, error STRING"
STATES = ("started", "completed", "failed")


@dataclass(frozen=True)
class Policy:
    """Fixed value: a run every four hours, an hour's wait after an error."""

    interval: timedelta = timedelta(hours=4)
    retry_wait: timedelta = timedelta(hours=1)
    max_wait: timedelta = timedelta(hours=16)
    lease: timedelta = timedelta(hours=12)


def _later(ts: Column, wait: timedelta) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(wait // timedelta(microseconds=1)).cast("long"))


def schedule(events: DataFrame, now: Column, policy: Policy = Policy()) -> DataFrame:
    """(job, state, failures, due, is_due): the last state of each job, failures since it last completed, and when it may run next.

    Events of one run share `run_id`; its last event counts, of one time the one whose state comes last. Added up per job, before and after
    the shuffle, so a job with many runs is no group.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col("state"))
    last = F.max(F.struct("at", rank.alias("rank"), "started", "state"))
    runs = events.filter(rank > 0).groupBy("job", "run_id").agg(last.alias("run")).select("job", "run.*")
    lost = (F.col("state") == "started") & (_later(F.col("started"), policy.lease) <= now)
    runs = runs.withColumns({"at": F.when(lost, _later(F.col("started"), policy.lease)).otherwise(F.col("at")), "state": F.when(lost, "failed").otherwise(F.col("state"))})
    done = runs.groupBy("job").agg(F.max(F.when(F.col("state") == "completed", F.col("at"))).alias("done"), F.max(F.struct("started", "at", "state")).alias("last"))
    marked = done.select(F.col("job").alias("of"), "done", "last")
    failed = runs.filter("state = 'failed'").join(marked.select("of", "done"), F.col("job").eqNullSafe(F.col("of")))
    counts = failed.filter(F.col("done").isNull() | (F.col("at") > F.col("done"))).groupBy("of").agg(F.count("*").alias("n")).withColumnRenamed("of", "which")
    jobs = marked.join(counts, F.col("of").eqNullSafe(F.col("which")), "left").select(F.col("of").alias("job"), "last.*", F.coalesce("n", F.lit(0)).alias("failures"))
    micros = lambda t: F.lit(t // timedelta(microseconds=1)).cast("double")
    wait = F.least(micros(policy.max_wait), micros(policy.retry_wait) * F.pow(F.lit(2.0), F.greatest(F.col("failures") - 1, F.lit(0)))).cast("long")
    due = (F.when(F.col("state") == "completed", _later(F.col("started"), policy.interval))
           .when(F.col("state") == "failed", F.timestamp_micros(F.unix_micros("at") + wait)).otherwise(_later(F.col("started"), policy.lease)))
    return jobs.select("job", "state", F.col("failures").cast("long").alias("failures"), due.alias("due"), ((F.col("state") != "started") & (due <= now)).alias("is_due"))


def due_jobs(events: DataFrame, now: Column, policy: Policy = Policy()) -> DataFrame:
    """The jobs that may run now, the one that waited longest first."""
    return schedule(events, now, policy).filter("is_due").orderBy("due", "job")


def record(spark: SparkSession, path: str, job: str, run_id: str, state: str, started: datetime, at: datetime, error: str | None = None) -> None:
    """A change of a run's state; recorded twice it counts once."""
    row = spark.createDataFrame([(job, run_id, state, started, at, error)], EVENTS)
    batches.append_batch(row.coalesce(1), path, f"{job}/{run_id}/{state}")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return batches.read_batches(spark, path, EVENTS)


def run_if_due(spark: SparkSession, path: str, job: str, work: Callable[[str], None], clock: Callable[[], datetime], policy: Policy = Policy()) -> str:
    """'waiting' if the job is not due, else 'completed' or 'failed' after its run; `work` gets the run's id. A failure is recorded, not raised."""
    started = clock()
    known = schedule(read_events(spark, path).filter(F.col("job") == job), F.lit(started), policy).first()
    if known is not None and not known["is_due"]:
        return "waiting"
    run_id = started.strftime("%Y%m%d_%H%M%S_%f")
    record(spark, path, job, run_id, "started", started, started)
    try:
        work(run_id)
    except Exception as e:  # noqa: BLE001 - whatever a run dies of is its outcome
        record(spark, path, job, run_id, "failed", started, clock(), str(e))
        return "failed"
    record(spark, path, job, run_id, "completed", started, clock())
    return "completed"
