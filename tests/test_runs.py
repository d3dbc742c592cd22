"""Ledger snapshots, run control, results merged set by set, counters in update mode."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from gleanwork.operators import dedup, joins
from gleanwork.sources import batches, ledger, readers, writers
from gleanwork.streaming import crawl as streams
from gleanwork.streaming import runs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def marks(spark, pairs):
    return spark.createDataFrame(pairs, "url STRING, status STRING")


def test_snapshots_know_what_the_marks_said(spark, tmp_path):
    path, rng = str(tmp_path / "ledger"), random.Random(1)
    assert rows(ledger.latest(spark, path)) == []
    requests = spark.createDataFrame([(f"u{i}", i) for i in range(60)] + [(None, 99)], "url STRING, ord INT")
    for run in range(9):
        some = [(f"u{rng.randrange(50)}", rng.choice(["completed", "failed", "failed", "dead"])) for _ in range(12)]
        writers.append_ledger(marks(spark, some), path, "url", "status", str(run))
        if run in (2, 3, 6):
            ledger.compact(spark, path, buckets=4)
        if run in (1, 2, 5, 8):
            every = readers.read_ledger(spark, path)
            assert rows(ledger.frontier(spark, path, requests)) == rows(joins.frontier(requests, every, "url"))
            assert rows(ledger.latest(spark, path).select("url", "attempts")) == rows(every.groupBy("url").count())
            last = every.groupBy("url").agg(F.max(F.struct("ts", "run_id", "status")).alias("m")).select("url", "m.status")
            assert rows(ledger.latest(spark, path).select("url", "status")) == rows(last)
    # Marks of a run that the snapshot covers, written once more, are not counted again.
    before = rows(ledger.latest(spark, path))
    writers.append_ledger(marks(spark, [("u1", "failed")]), path, "url", "status", "3")
    assert rows(ledger.latest(spark, path)) == before


def test_only_requests_move_to_the_snapshot(spark, tmp_path):
    path = str(tmp_path / "ledger")
    writers.append_ledger(spark.range(2000).select(F.concat(F.lit("u"), F.col("id")).alias("url"), F.lit("completed").alias("status")), path, "url", "status", "0")
    ledger.compact(spark, path, buckets=4)
    writers.append_ledger(marks(spark, [("u2500", "completed")]), path, "url", "status", "1")
    requests = spark.range(1000, 3000).select(F.concat(F.lit("u"), F.col("id")).alias("url"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        todo = ledger.frontier(spark, path, requests)
        assert todo.count() == 999
        plan = todo._jdf.queryExecution().sparkPlan().toString() + todo._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SelectedBucketsCount: 4 out of 4" in plan
    lines = plan.splitlines()
    at = max(i for i, line in enumerate(lines) if "SelectedBucketsCount" in line)
    depth = lines[at].index("FileScan")
    for line in reversed(lines[:at]):
        inner = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if inner < depth:
            assert "Exchange" not in line, plan
            if "Join" in line:
                break
            depth = inner


def test_a_crawl_of_many_runs_reads_a_snapshot_and_the_last_marks(spark, tmp_path):
    path, out = str(tmp_path / "ledger"), str(tmp_path / "out")
    requests = marks(spark, [(f"u{i}", "") for i in range(9)]).select("url")

    def fetch(todo):
        return todo.select("url", F.when(F.crc32("url") % 3 == F.lit(run % 3), "completed").otherwise("failed").alias("status"))

    for run in range(7):
        ledger.run_once(spark, path, out, requests, f"r{run:02d}", fetch, compact_every=3)
        assert len(batches.attempts(spark, path).keys() - ledger._state(spark, path)[2]) < 3
    assert ledger.frontier(spark, path, requests).count() == 0
    done = rows(batches.read_batches(spark, out).filter("status = 'completed'").select("url"))
    assert done == rows(requests)
    # Repeated, the last run finds what it found before.
    ledger.run_once(spark, path, out, requests, "r06", fetch, compact_every=3)
    assert rows(batches.read_batches(spark, out).filter("status = 'completed'").select("url")) == done


# --- runs ---------------------------------------------------------------------------------------

T = datetime(2024, 5, 1, tzinfo=timezone.utc)
POLICY = runs.Policy(timedelta(hours=4), timedelta(hours=1), timedelta(hours=6), timedelta(hours=2))


def test_failure_back_off_and_resume(spark, tmp_path):
    path, asked = str(tmp_path / "runs"), []

    def at(hours, good=True, takes=0.0):
        times = iter([T + timedelta(hours=hours), T + timedelta(hours=hours + takes)])

        def work(run_id):
            asked.append(run_id)
            if not good:
                raise RuntimeError("blocked")

        return runs.run_if_due(spark, path, "hunt", work, lambda: next(times), POLICY)

    assert at(0, takes=0.5) == "completed"
    assert at(3.9) == "waiting" and at(4, good=False, takes=0.25) == "failed"  # four hours after the start
    assert at(5) == "waiting" and at(5.25, good=False) == "failed"  # an hour after the failure
    assert at(7.2) == "waiting" and at(7.25, good=False) == "failed"  # two hours
    assert at(11.2) == "waiting" and at(11.25, good=False) == "failed"  # four
    assert at(17.2) == "waiting" and at(17.25) == "completed"  # six at most, not eight
    assert at(21) == "waiting" and at(21.25, good=False) == "failed" and at(22.25) == "completed"  # counted anew
    assert len(asked) == len(set(asked)) == 8
    told = runs.schedule(runs.read_events(spark, path), F.lit(T + timedelta(hours=30)), POLICY).first()
    assert (told["job"], told["state"], told["failures"], told["is_due"]) == ("hunt", "completed", 0, True)
    errors = runs.read_events(spark, path).filter("state = 'failed'").select("error").distinct().collect()
    assert [r.error for r in errors] == ["blocked"]


def test_a_run_that_is_not_heard_of(spark, tmp_path):
    path = str(tmp_path / "runs")
    for _ in range(2):  # recorded twice, counted once
        runs.record(spark, path, "a", "1", "started", T, T)
    runs.record(spark, path, "b", "1", "started", T, T)
    runs.record(spark, path, "b", "1", "completed", T, T)

    def due(hours):
        return [(r["job"], r["failures"]) for r in runs.due_jobs(runs.read_events(spark, path), F.lit(T + timedelta(hours=hours)), POLICY).collect()]

    assert due(1.9) == due(2.9) == [] and due(3) == [("a", 1)] and due(5) == [("a", 1), ("b", 0)]


def test_no_events(spark):
    assert runs.due_jobs(spark.createDataFrame([], runs.EVENTS), F.lit(T)).count() == 0


# --- results ------------------------------------------------------------------------------------


def test_sets_added_one_by_one_equal_the_full_merge(spark, tmp_path):
    kept, rng = str(tmp_path / "kept"), random.Random(2)
    sets = []
    for g in range(3):
        data = [(rng.choice([f"k{rng.randrange(40)}", f"k{rng.randrange(400)}", None]), i, f"{g}") for i in range(80)]
        df = spark.createDataFrame(data, "page_url STRING, ord INT, v STRING")
        sets.append(df if g != 1 else df.withColumn("extra", F.lit("x")))
    want = dedup.merge_generations(sets, "page_url", "ord")
    for name, df in (("a", sets[0]), ("b", sets[1]), ("b", sets[1]), ("c", sets[2])):
        dedup.add_generation(df, kept, "page_url", "ord", name, buckets=8)
    got = dedup.read_kept(spark, kept)
    assert rows(got.select(sorted(want.columns))) == rows(want.select(sorted(want.columns)))
    # A small set reads the buckets of its keys and adds its new keys only.
    dedup.add_generation(spark.createDataFrame([("k1", 1, "z"), ("new", 2, "z")], "page_url STRING, ord INT, v STRING"), kept, "page_url", "ord", "d", buckets=8)
    last = batches.attempts(spark, kept)["d"]
    assert [r.page_url for r in batches.read_attempts(spark, kept, [last]).collect()] in (["new"], ["k1", "new"], ["new", "k1"])
    assert dedup.read_kept(spark, kept).filter("page_url = 'k1'").count() == 1


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_counters(spark, tmp_path, mode):
    inbox, sink, checkpoint = (str(tmp_path / p) for p in ("in", "sink", "cp"))
    for part in (["a", "b"], ["a"], ["c", "a"]):
        spark.createDataFrame([(s,) for s in part], "status STRING").coalesce(1).write.mode("append").parquet(inbox)
    for _ in range(2):
        stream = streams.stream_files(spark, inbox, "status STRING", files_per_batch=1)
        streams.status_counts(stream, "status", sink, checkpoint, mode).awaitTermination()
    assert rows(streams.read_counts(spark, sink)) == [("a", 3), ("b", 1), ("c", 1)]
    with pytest.raises(ValueError):
        streams.status_counts(stream, "status", sink, checkpoint, "append")
