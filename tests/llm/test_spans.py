"""What matching costs, and that what is skipped holds no match."""

import random

from pyspark.sql import functions as F

from gleanwork.llm import pii, spans


def test_the_fit_matches_every_pattern_once(spark):
    df = spark.createDataFrame([("call 202-555-0100 or mail a at b dot com",), ("",), (None,)], "text string")
    rows = pii._labelled(df, "text")
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(") == len(pii.STRICT | pii.WIDE)
    assert sorted((r["spelt"], r["positive"]) for r in rows.collect()) == [(0, 1), (1, 1)]


def test_the_plan_of_the_fit_stays_small(spark):
    """The driver holds plans: this one had 215 thousand characters when Spark copied the matching into a filter."""
    rows = pii._labelled(spark.createDataFrame([("x",)], "text string"), "text")
    assert len(rows._jdf.queryExecution().optimizedPlan().toString()) < 60_000


def test_texts_without_matches_are_not_split(spark):
    df = spark.range(1).select(F.lit("ab").alias("text"))
    got = spans.with_matches(df, "text", {"x": "x", "b": "b"}, {"x": "y"}).select("x", F.transform("b", lambda m: m["start"]).alias("b")).first()
    assert (got["x"], got["b"]) == ([], [1])
    # Of texts without what a pattern needs it is not even tried.
    never = spans.with_matches(df, "text", {"b": "b"}, {"b": "c"}).select("b").first()
    assert never["b"] == []


def test_needs_lose_no_match(spark):
    rng = random.Random(6)
    pieces = ["a", "b.c", "@", ".", "1", "22", "1.2.3.4", " ", " at ", " AT ", "(at)", "[AT]", " dot ", "(DOT)", "[dot]", "-", "é", "ſ", "İ", "+49", "\n", "x@y.z", "9.9"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(14))) for _ in range(3000)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    patterns = {k: v for k, v in (pii.STRICT | pii.WIDE).items() if k in pii.NEEDS}
    with_needs, without = (
        [tuple(r) for r in spans.with_matches(df.coalesce(1), "text", patterns, n).select(*patterns).collect()] for n in (pii.NEEDS, None))
    assert with_needs == without
    assert all(sum(bool(r[i]) for r in without) > 9 for i in range(len(patterns)))
