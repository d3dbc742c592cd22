"""What the operators move and sort, on made-up rows."""

import json
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanwork.llm import components, near_dup, quality, toxicity
from gleanwork.session import staged

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(autouse=True)
def _shared(spark, tmp_path_factory):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


def test_near_duplicates_shuffle_few_texts(tmp_path):
    """Of 300 long texts 10 have a near copy: only these are moved, for the check on full sets and for the removal."""
    code = f"""
import random, sys; sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
from gleanwork.llm import near_dup
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", {str(tmp_path / "log")!r})
    .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.sql.autoBroadcastJoinThreshold", "-1")
    .config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate())
rng = random.Random(4)
texts = [" ".join(str(rng.randrange(10**9)) for _ in range(3000)) for _ in range(300)]
texts += [t + " end" for t in texts[:10]]
spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet("{tmp_path}/docs")
kept = near_dup.keep_one(spark.read.parquet("{tmp_path}/docs"))
kept.write.parquet("{tmp_path}/kept")
assert sorted(r[0] for r in spark.read.parquet("{tmp_path}/kept").select("doc_id").collect()) == list(range(300))
print(sum(map(len, texts)))
spark.stop()
"""
    (tmp_path / "log").mkdir()
    chars = int(subprocess.run([sys.executable, "-c", code], check=True, timeout=200, capture_output=True, text=True).stdout.split()[-1])
    events = [json.loads(x) for log in (tmp_path / "log").iterdir() if not log.name.startswith(".") for x in log.read_text().splitlines()]
    written = sum(e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"] for e in events if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"))
    assert 0 < written < chars / 2


@pytest.mark.parametrize("most", [1 << 28, 1])
def test_a_sieve_lets_every_wanted_row_pass(spark, monkeypatch, most):
    monkeypatch.setattr(near_dup, "SIEVE_MOST", most)
    rows = spark.range(60000).select(F.when(F.col("id") % 100 != 7, F.col("id")).alias("doc"), F.xxhash64("id").alias("tk"), "id")
    wanted = staged(rows.filter("id % 10 = 7").select(F.col("doc").alias("__doc"), F.col("tk").alias("__tk")), "wanted")
    got = near_dup._sieved(rows, F.col("doc"), F.col("tk"), wanted)
    assert got.columns == ["doc", "tk", "id", "__met"]
    n = {(r["w"], r["__met"]): r["count"] for r in got.groupBy((F.col("id") % 10 == 7).alias("w"), "__met").count().collect()}
    assert n[True, True] == 6000 and (True, False) not in n
    assert n[False, True] + n[False, False] == 54000 and (most == 1 or n[False, True] < 6000)
    none = near_dup._sieved(rows, F.col("doc"), F.col("tk"), wanted.limit(0))
    assert none.filter("__met").count() == 0 and none.count() == 60000


def test_features_are_not_hashed_to_tell_them_apart(monkeypatch):
    """`np.unique` without counts or positions puts its values through a hash table, which took most of the time."""
    plain, hashed = np.unique, [0]

    def unique(x, *args, **kwargs):
        hashed.append(0 if args or kwargs else len(x))
        return plain(x, *args, **kwargs)

    text = " ".join(f"word{i % 700} and{i}" for i in range(2000)).encode()
    toxicity.features(np.frombuffer(b"go die", np.uint8), np.array([0, 6]))
    monkeypatch.setattr(toxicity.np, "unique", unique)
    slot, owner = toxicity.features(np.frombuffer(text * 2, np.uint8), np.array([0, len(text), 2 * len(text)]))
    both = (owner << toxicity.BITS) | slot
    assert max(hashed) < len(both) / 2
    assert (np.diff(both) > 0).all() and slot[owner == 0].tolist() == slot[owner == 1].tolist()
    assert toxicity.distinct(np.zeros(0, np.int64)).tolist() == [] and toxicity.distinct(np.array([3, 1, 3])).tolist() == [1, 3]


def _joined(links):
    """{node: smallest node reachable}, without the smallest ones."""
    low = {x: x for link in links for x in link}
    while (now := {x: min([low[x], *[low[y] for link in links if x in link for y in link]]) for x in low}) != low:
        low = now
    return {x: v for x, v in low.items() if x != v}


@pytest.mark.parametrize("chunk", [1 << 16, 3])
def test_components_spend_no_round_on_what_a_chunk_or_the_links_tell(spark, monkeypatch, chunk):
    """A chain within a chunk is no chain any more, and stars need no round to see that they stay; what chunks leave is joined by rounds."""
    rounds, starred = [], components._starred
    monkeypatch.setattr(components, "_starred", lambda *a: rounds.append(0) or starred(*a))
    monkeypatch.setattr(components, "CHUNK", chunk)
    rng = np.random.default_rng(5)
    links = [(i, i + 1) for i in range(30)] + [(int(a), int(b)) for a, b in rng.integers(100, 160, (40, 2))] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    frame = spark.createDataFrame(links, "a long, b long").coalesce(1)
    monkeypatch.setattr(components, "_contracted", _by_rows(components._contracted) if chunk == 3 else components._contracted)
    rows = components.components(frame).collect()
    assert {r["node"]: r["low"] for r in rows} == _joined([x for x in links if None not in x]) and len(rows) == len({r["node"] for r in rows})
    assert bool(rounds) == (chunk == 3)
    rounds.clear()
    stars = [(0, k) for k in range(1, 9)] + [(50, 90), (60, 90 + 1)]
    assert {r["node"]: r["low"] for r in components.components(spark.createDataFrame(stars, "a int, b int").repartition(4)).collect()} == _joined(stars)
    assert not rounds
    assert components.components(frame.limit(0)).collect() == []


def _by_rows(contracted):
    """Batches of one row, each task's links three at a time."""
    def run(batches):
        chunk, components.CHUNK = components.CHUNK, 3
        try:
            yield from contracted(b.slice(k, 1) for b in batches for k in range(b.num_rows))
        finally:
            components.CHUNK = chunk
    return run


def test_word_vectors_are_let_go_when_all_is_scored(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} and more {i}" if i % 2 else "!!", None if i % 5 else "x") for i in range(60)], "doc_id long, text string, own string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS quality")
    good = quality.keep_good(docs, labels)
    assert good.columns == docs.columns and "MapInArrow" not in good._jdf.queryExecution().toString()
    scored = quality.score_quality(docs, labels, docs.columns).filter("predicted = 1").select(docs.columns)
    assert 0 < good.count() < 60 and sorted(map(repr, good.collect())) == sorted(map(repr, scored.collect()))
