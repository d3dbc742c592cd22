"""CSV headers, broken files and appended batches."""

import bz2
import gzip
import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gleanwork import schemas
from gleanwork.operators import enrich
from gleanwork.sources import batches, files, readers, writers

SCHEMA = "url STRING, name STRING, n INT"


@pytest.fixture
def results(tmp_path):
    root = tmp_path / "results"
    root.mkdir()
    (root / "a.csv").write_text('url,n,name\nu1,1,"x, ""y""\nz"\nu2,bad,N/A\n\nu3\n')
    (root / "b.csv.gz").write_bytes(gzip.compress("﻿name , url\nb,u4\n".encode()))
    (root / "c [1].csv").write_text("n,url,url\r\n7,u5,other\r\n")
    (root / "d.csv.bz2").write_bytes(bz2.compress(b"url\n" + b"".join(b"d%d\n" % i for i in range(25000))))
    (root / "empty.csv").write_text("")
    (root / "blank.csv").write_text("\n")
    (root / "cut.csv.gz").write_bytes(gzip.compress(b"url,name\n" + os.urandom(5000).hex().encode())[:-900])
    (root / "byte.csv").write_bytes(b"url,name\nu6,ok\nu7,\xff\n")
    (root / "other.csv").write_text("x,y\n1,2\n")
    return root


def test_sound_files_are_read_and_others_reported(spark, results):
    path = f"{results}/*"
    rows = [tuple(r)[:3] for r in readers.read_generations(spark, path, SCHEMA).collect()]
    some = [r for r in rows if not r[0].startswith("d")]
    assert sorted(some) == [("u1", 'x, "y"\nz', 1), ("u2", None, None), ("u3", None, None), ("u4", "b", None), ("u5", None, 7)]
    assert sorted(r[0] for r in rows if r[0].startswith("d")) == sorted(f"d{i}" for i in range(25000))
    bad = {Path(r["file_path"]).name: r["reason"] for r in readers.rejected_files(spark, path, SCHEMA).collect()}
    assert bad.pop("cut.csv.gz").startswith("damaged") and bad.pop("byte.csv").startswith("not UTF-8")
    assert bad == {"blank.csv": files.NO_HEADER, "other.csv": files.NO_COLUMN}  # files without a byte are not listed


def test_files_too_large_for_a_task_give_the_same(spark, results):
    def told(whole_bytes):
        rows = files.read_whole(spark, f"{results}/*", SCHEMA, multi_line=True, whole_bytes=whole_bytes).collect()
        return sorted(repr((r["url"], r["name"], r["n"], Path(r["file_path"].replace("%20", " ").replace("%5B", "[").replace("%5D", "]")).name, (r["reason"] or "")[:7])) for r in rows)

    assert told(0) == told(files.WHOLE_BYTES)


def test_every_row_is_read_once(tmp_path):
    """By the event log of a session of its own: several splits a file, two headers."""
    code = f"""
import sys; sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
from pyspark.sql import SparkSession
from gleanwork.sources import readers
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", {str(tmp_path / "log")!r})
    .config("spark.eventLog.compress", "false").config("spark.sql.files.maxPartitionBytes", "200k").getOrCreate())
for i, names in enumerate(("tool_id,tool_name,tool_url", "tool_url,tool_id,tool_name")):
    with open(f"{tmp_path}/t{{i}}.csv", "w") as f:
        f.write(names + "\\n" + "".join(f"{{k}},{{k}},{{k}}\\n" for k in range(50000)))
rows = readers.read_csv(spark, "{tmp_path}/t*.csv", "tool_id BIGINT, tool_name STRING, tool_url STRING")
assert rows.agg({{"tool_id": "sum"}}).first()[0] == 2 * sum(range(50000))
spark.stop()
"""
    (tmp_path / "log").mkdir()
    subprocess.run([sys.executable, "-c", code], check=True, timeout=200, capture_output=True)
    read = 0
    for log in (tmp_path / "log").rglob("*"):
        for line in log.read_text().splitlines() if log.is_file() and not log.name.startswith((".", "appstatus")) else ():
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd":
                read += event["Task Metrics"]["Input Metrics"]["Records Read"]
    assert 100000 <= read <= 105000


def test_headers_are_read_as_csv():
    assert files.split_header('﻿"a, b", c ,d\r') == ["a, b", "c", "d"] and files.split_header("") == []


def test_a_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    assert batches.read_batches(spark, path, "id LONG").count() == 0
    ended = batches.write_attempt(spark.range(5), path)
    writers.append_rows(spark.range(5), path, "one")
    writers.append_rows(spark.range(5, 7), path, "two")
    writers.append_rows(spark.range(6), path, "one")
    writers.append_rows(spark.range(0), path, "none")
    writers.append_rows(spark.range(100, 102), path)
    assert sorted(r.id for r in readers.read_rows(spark, path).collect()) == [0, 1, 2, 3, 4, 5, 5, 6, 100, 101]
    assert sorted(r.id for r in batches.read_batches(spark, path, "id LONG", without="one").collect()) == [5, 6, 100, 101]
    assert ended not in batches.attempts(spark, path).values()


def test_a_repeated_run_replaces_its_marks(spark, tmp_path):
    path = str(tmp_path / "ledger")
    marks = spark.createDataFrame([("a", "completed"), ("b", "failed")], "u STRING, s STRING")
    for run in ("1", "1", "2"):
        writers.append_ledger(marks, path, "u", "s", run)
    writers.append_ledger(marks.limit(1), path, "u", "s", "2", batch="2-more")
    assert readers.read_ledger(spark, path).groupBy("run_id").count().orderBy("run_id").collect() == [("1", 2), ("2", 3)]


def test_answers_of_an_ended_run_are_asked_again(spark, tmp_path):
    store = str(tmp_path / "answers")
    df = spark.createDataFrame([(i, f"p{i % 4}") for i in range(40)], "id INT, p STRING")
    ask = lambda: sorted(tuple(r) for r in enrich.enrich_with_store(df, F.col("p"), lambda ps: [p.upper() for p in ps], store).collect())
    want = [(i, f"p{i % 4}", f"P{i % 4}", None) for i in range(40)]
    ended = spark.createDataFrame([("x" * 64, "y", None)], enrich._STORE)
    batches.write_attempt(ended, store)
    assert ask() == ask() == want
    assert enrich.read_answers(spark, store).count() == 4


@pytest.mark.parametrize("in_flight", [1, 3])
def test_one_bad_prompt_leaves_the_others_their_answers(spark, in_flight):
    def infer(prompts):
        if "p17" in prompts:
            raise RuntimeError("no")
        return prompts

    df = spark.range(120).select(F.concat(F.lit("p"), F.col("id")).alias("p")).coalesce(1)
    rows = enrich.enrich(df, F.col("p"), infer, 50, in_flight).collect()
    assert [(r.p, r.response, r.error) for r in rows] == [(f"p{i}", None if i == 17 else f"p{i}", "no" if i == 17 else None) for i in range(120)]
    calls = []

    def counted(prompts):
        calls.append(len(prompts))
        return infer(prompts)

    assert len(enrich.answers(counted, [f"p{i}" for i in range(50)])) == 50 and len(calls) <= 13
    assert enrich.answers(lambda ps: ps[1:], ["a", "b"]) == [(None, "0 answers for 1 prompts")] * 2


def test_seed_schema_is_read_from_gz(spark, tmp_path):
    (tmp_path / "t.csv.gz").write_bytes(gzip.compress(b"tool_name,tool_id,tool_url\nA,1,u\n"))
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "t.csv.gz"), schemas.TOOL_SEED).collect()] == [(1, "A", "u")]
