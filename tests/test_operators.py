import random

import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gleanwork.functions import predicates
from gleanwork.operators import aggregates, dedup, joins, keywords, ordinals, skew


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()] if order else sorted(
        [tuple(r) for r in df.collect()], key=str
    )


@pytest.fixture(scope="module")
def keyed(spark):
    """Two frames with repeated and missing keys; a third of the left rows share one key."""
    rng = random.Random(3)
    left = [(i, 7 if i % 3 == 0 else rng.choice([None, 1, 2, 3, 4]), f"l{i}") for i in range(120)]
    right = [(rng.choice([None, 1, 2, 7, 9]), f"r{i}") for i in range(30)]
    return left, right, frame(spark, left, "ord INT, k INT, v STRING"), frame(spark, right, "k INT, v STRING")


@pytest.mark.parametrize("spread", [None, ["ord"]])
@pytest.mark.parametrize("nulls", ["match", "drop"])
def test_merge_equals_pandas(keyed, spread, nulls):
    left, right, ldf, rdf = keyed
    got = joins.merge(ldf, rdf, "k", null_keys=nulls, spread_by=spread)
    assert got.columns == ["ord", "k", "v_x", "v_y"]
    want = [(o, k, a, b) for o, k, a in left for k2, b in right if k == k2 and (k is not None or nulls == "match")]
    assert rows(got) == sorted(want, key=str)
    if nulls == "match":
        a = pd.DataFrame(left, columns=["ord", "k", "v"]).astype({"k": object})
        b = pd.DataFrame(right, columns=["k", "v"]).astype({"k": object})
        assert len(pd.merge(a, b, on="k")) == len(want)


@pytest.mark.parametrize("parts", [1, 5, 10000])
def test_salting_both_sides_equals_plain(keyed, parts):
    """From no key hot to every repeated one."""
    left, right, ldf, rdf = keyed
    got = skew.salted_join(ldf, rdf.withColumnRenamed("v", "w"), ["k"], ["ord"], "inner", "match", ["w"], parts)
    want = [(o, k, a, b) for o, k, a in left for k2, b in right if k == k2]
    assert got.columns == ["ord", "k", "v", "w"] and rows(got) == sorted(want, key=str)


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_salted_join_equals_plain(keyed, how):
    left, right, ldf, rdf = keyed
    once = rdf.select("k").distinct().withColumn("hit", F.lit(1))
    known = {k for k, _ in right}
    got = rows(skew.salted_join(ldf, once, ["k"], ["ord"], how, parts=5))
    want = {
        "left": [(*r, 1 if r[1] in known else None) for r in left],
        "left_semi": [r for r in left if r[1] in known],
        "left_anti": [r for r in left if r[1] not in known],
    }[how]
    assert got == sorted(want, key=str)


def test_salting_evens_out_the_partitions(spark):
    """A third of the rows share one key; no task gets more than three times its part."""
    left = spark.range(30000).selectExpr("id AS ord", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 1009 END AS k")
    right = spark.range(1009).selectExpr("id AS k", "id AS w")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        largest = [
            max(r["count"] for r in joins.merge(left, right, "k", spread_by=by).groupBy(F.spark_partition_id()).count().collect())
            for by in (None, ["ord"])
        ]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert largest[0] > 10000 and largest[1] < 3 * 30000 / 8


def test_hot_keys_are_bounded(keyed):
    assert [r.k for r in skew.hot_keys(keyed[2], ["k"], 5).collect()] == [7]


def test_empty_tables_have_no_hot_keys(spark, tmp_path):
    spark.createDataFrame([], "k int, v int").write.parquet(f"{tmp_path}/none")
    none = spark.read.parquet(f"{tmp_path}/none")
    assert skew.hot_keys(none, ["k"], 5).count() == 0
    assert skew.salted_join(none, none.withColumnRenamed("v", "w"), ["k"], ["v"], "left", parts=5).count() == 0


@pytest.mark.parametrize("hot", [3, 250])
def test_small_hot_keys_are_salted_when_parts_are_many(spark, hot):
    """One key at a third or at 0.4 % of the rows: no salt of it exceeds a fair part by much."""
    rows = spark.range(60000).selectExpr("id AS ord", f"CASE WHEN id % {hot} = 0 THEN -1 ELSE id END AS k")
    parts = 1000
    got = {r.k: r["__salts"] for r in skew.hot_keys(rows, ["k"], parts).collect()}
    n = 60000 // hot
    assert set(got) == {-1} and n / got[-1] <= 60000 / parts


def test_members(keyed):
    left, right, ldf, rdf = keyed
    known = {k for k, _ in right}
    assert {r.ord for r in joins.members(ldf, rdf, "k").collect()} == {o for o, k, _ in left if k in known}
    assert {r.ord for r in joins.non_members(ldf, rdf, "k").collect()} == {o for o, k, _ in left if k not in known}


def test_add_missing_ids(spark):
    base = frame(spark, [(1, "a"), (2, "b"), (2, "c"), (3, "d"), (None, "e")], "k INT, v STRING")
    ids = frame(spark, [(2,), (3,), (99,), (None,)], "k INT")
    got = joins.add_missing_ids(base.filter("k = 3"), base, ids, "k")
    assert rows(got) == sorted([(3, "d"), (2, "b"), (2, "c"), (None, "e")], key=str)


def test_lookup_last(spark):
    dim = frame(spark, [(1, "a", 10), (2, "a", None), (3, "b", 30), (4, None, 40)], "ord INT, n STRING, id INT")
    df = frame(spark, [("a",), ("b",), ("c",), (None,)], "n STRING")
    assert rows(joins.lookup_last(df, dim, "n", ["id"], "ord")) == sorted([("a", None), ("b", 30), ("c", None), (None, None)], key=str)


@pytest.mark.parametrize("spread", [None, ["ord"]])
def test_update_from(spark, spread):
    base = frame(spark, [(1, 1, "a"), (2, 1, None), (3, 2, "c"), (4, None, "d")], "ord INT, k INT, v STRING")
    edits = frame(spark, [(1,), (1,), (None,)], "k INT")
    got = joins.update_from(base, edits, "k", {"v": F.concat(F.coalesce("v", F.lit("")), F.lit("!"))}, spread)
    assert rows(got, "ord") == [(1, 1, "a!"), (2, 1, "!"), (3, 2, "c"), (4, None, "d!")]


def test_overwrite_from(spark):
    base = frame(spark, [(1, "a", "x"), (2, "b", "x"), (None, "c", "x")], "k INT, v STRING, w STRING")
    edits = frame(spark, [("new", 1), (None, 2)], "v STRING, k INT")
    assert rows(joins.overwrite_from(base, edits, "k", ["v"])) == sorted([(1, "new", "x"), (2, None, "x"), (None, "c", "x")], key=str)


def test_frontier(spark):
    urls = frame(spark, [("a",), ("b",), ("c",)], "url STRING")
    ledger = frame(spark, [("a", "completed"), ("b", "failed")], "url STRING, status STRING")
    assert rows(joins.frontier(urls, ledger, "url")) == [("b",), ("c",)]
    assert rows(joins.frontier(urls, ledger, "url", retry_failed=False)) == [("c",)]


def test_attach_results(spark):
    got = joins.attach_results(
        frame(spark, [("a",), ("b",)], "url STRING"), frame(spark, [("a", "T", None)], "url STRING, t STRING, e STRING"),
        "url", {"t": "N/A"},
    )
    assert rows(got, "url") == [("a", "T", None), ("b", "N/A", None)]


def test_keep_first_treats_nulls_as_equal(spark):
    df = frame(spark, [(1, None, "a"), (2, None, "b"), (3, "k", "c"), (4, "k", "d")], "ord INT, k STRING, v STRING")
    assert rows(dedup.keep_first(df, ["k"], ["ord"]), "ord") == [(1, None, "a"), (3, "k", "c")]
    plan = dedup.keep_first(df, ["k"], ["ord"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one of them in front of the shuffle


def test_title_dedup(spark):
    df = frame(spark, [(1, "A b"), (2, " a B\t"), (3, "A b"), (4, None), (5, "")], "ord INT, t STRING")
    assert [r.ord for r in dedup.dedup_exact_title(df, "t", "ord").orderBy("ord").collect()] == [1, 2, 4]
    assert [r.ord for r in dedup.dedup_normalized_title(df, "t", "ord").orderBy("ord").collect()] == [1, 4]


def test_merge_generations(spark):
    old = frame(spark, [(1, "u", 1), (2, "v", 2)], "ord INT, page_url STRING, x INT")
    new = frame(spark, [(1, "v", "n"), (2, "w", "n")], "ord INT, page_url STRING, note STRING")
    got = dedup.merge_generations([old, new], "page_url", "ord").select("page_url", "generation", "x", "note")
    assert rows(got, "page_url") == [("u", 0, 1, None), ("v", 0, 2, None), ("w", 1, None, "n")]


@pytest.mark.parametrize("n", [0, 1, 5, 97])
def test_positions_batches_shards(spark, n):
    rng = random.Random(n)
    ids = rng.sample(range(-10**12, 10**12), n)
    df = frame(spark, [(i,) for i in ids], "id LONG")
    order = {v: i for i, v in enumerate(sorted(ids))}
    got = ordinals.with_position(df, "id", parts=7).collect()
    assert {r.id: r.position for r in got} == order
    assert {r.id: r.batch_id for r in ordinals.batch_ids(df, "id", 3).collect()} == {v: i // 3 for v, i in order.items()}
    size = n // 8
    want = {v: 7 if size == 0 else min(i // size, 7) for v, i in order.items()}
    assert {r.id: r.shard_id for r in ordinals.shards(df, "id", 8).collect()} == want


def test_slice_and_sample(spark):
    df = spark.range(50)
    assert [r.id for r in ordinals.row_slice(df, "id", 10, 13).collect()] == [10, 11, 12]
    one, two = (sorted(r.id for r in ordinals.repeatable_sample(df.repartition(p), "id", 5, 3).collect()) for p in (2, 7))
    assert one == two and len(one) == 5


@pytest.mark.parametrize("kind", ["LONG", "TIMESTAMP", "DOUBLE", "STRING"])
def test_deep_slices(spark, kind):
    """Values close together and far apart, nulls, and ends beyond the table."""
    rng = random.Random(8)
    ids = list({*rng.sample(range(2000), 900), *(rng.randrange(-2**40, 2**40) for _ in range(300)), *((2**62 + i, -2**62 - i)[i % 2] for i in range(50) if kind == "LONG")})
    cast = "timestamp_micros(i)" if kind == "TIMESTAMP" else f"CAST(i AS {kind})"
    df = frame(spark, [(i,) for i in ids] + [(None,)], "i LONG").selectExpr("i", f"{cast} AS o").repartition(4)
    order = [None, *sorted(ids, key=str if kind == "STRING" else None)]
    for start, stop in ((0, 3), (0, 1), (1, 4), (700, 705), (len(order) - 2, len(order) + 9), (len(order) + 5, len(order) + 9), (600, 600), (0, 10**6)):
        got = ordinals.row_slice(df, "o", start, stop, top=0, few=7)
        assert [r.i for r in got.collect()] == order[start:stop]


def test_positions_of_strings_and_times(spark):
    df = spark.range(500).selectExpr("id", "md5(string(id)) AS s")
    got = ordinals.with_position(df, "s").orderBy("position").collect()
    assert [r.position for r in got] == list(range(500)) and [r.s for r in got] == sorted(r.s for r in got)


@pytest.mark.parametrize("n", [0, 1, 700, 2000, 5000])
def test_large_samples(spark, n):
    df = spark.range(2000).withColumn("x", F.col("id") % 7)
    small = ordinals.repeatable_sample(df, "id", n, 3)
    large = ordinals.repeatable_sample(df.repartition(5), "id", n, 3, top=-1, few=10)
    assert rows(large) == rows(small) and large.count() == min(n, 2000)
    assert n != 700 or ordinals._range_of_rank(df, F.col("id"), 699, 10)[2] > 600


def test_no_task_of_a_slice_sees_more_than_a_range(spark):
    df = spark.range(0, 1 << 20, 1, 8).select((F.col("id") * 7919 % (1 << 20)).alias("o"))
    got = ordinals.row_slice(df, "o", 900_000, 900_005, top=10, few=5000)
    assert [r.o for r in got.collect()] == list(range(900_000, 900_005))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "TakeOrdered" not in plan
    low, high, before = ordinals._range_of_rank(df, F.col("o"), 900_000, 5000)
    assert high - low < 5000 and before == low


def test_early_stop(spark):
    pages = frame(
        spark,
        [("a", 1, 5, False), ("a", 2, 0, False), ("a", 3, 4, False), ("b", 1, 0, False), ("c", 1, 2, False), ("c", 2, 2, True), (None, 1, 1, False)],
        "s STRING, p INT, n INT, f BOOLEAN",
    )
    got = ordinals.early_stop(pages, "s", "p", "n", "f").select("s", "p")
    assert rows(got) == sorted([("a", 1), ("c", 1), (None, 1)], key=str)


CATALOG = [
    (1, 10, None, "x; y;x", None), (2, 10, "n2", None, "p"), (3, 10, "n3", "z;y", "p; q"), (4, None, "n4", "a", "a"),
    (5, 11, None, None, None), (6, 12, "n6", "x", "x"), (7, 12, "n7", "x", "y"),
]
DDL = "ord INT, tool_id INT, name_tool STRING, use_original STRING, use_aggregated STRING"


def test_one_per_key_equals_pandas(spark):
    def merged(cells):
        return ";".join(dict.fromkeys(t.strip() for cell in cells.dropna() for t in cell.split(";") if t.strip()))

    pdf = pd.DataFrame(CATALOG, columns=["ord", "tool_id", "name_tool", "use_original", "use_aggregated"])
    want = pdf.groupby("tool_id").agg({"name_tool": "first", "use_original": merged, "use_aggregated": merged}).reset_index()
    got = aggregates.one_per_key(
        frame(spark, CATALOG, DDL).repartition(3), "tool_id", "ord", ["name_tool"], ["use_original", "use_aggregated"]
    )
    clean = lambda r: tuple(None if x is None or x != x else x for x in r)
    assert rows(got, "tool_id") == [clean(r) for r in want.itertuples(index=False)]


def test_duplicate_reports(spark):
    df = frame(spark, CATALOG, DDL)
    assert rows(aggregates.duplicate_overview(df, "tool_id")) == [(7, 3, 4, 2, 3)]
    assert rows(aggregates.exact_duplicate_count(df, ["tool_id", "use_original"])) == [(1,)]
    got = aggregates.explain_duplicates(df, "tool_id", "name_tool", ["use_original", "use_aggregated"], "ord", 10)
    assert rows(got, "tool_id") == [(10, None, 3, 2, 2), (12, "n6", 2, 1, 2)]
    values = aggregates.conflicting_values(df, "tool_id", ["use_aggregated"], 1)
    assert rows(values.select("tool_id", "value", "n_values"), "value") == [(10, "p", 2), (10, "p; q", 2)]


def test_frequency_drops_nulls_and_breaks_ties(spark):
    df = frame(spark, [("b",), ("a",), ("a",), ("b",), (None,), ("c",)], "k STRING")
    assert rows(aggregates.frequency(df, "k")) == [("a", 2), ("b", 2), ("c", 1)]
    assert rows(aggregates.top_k(df, "k", 1)) == [("a", 2)]


ARTICLE = "company STRING, has_image BOOLEAN, has_timestamp BOOLEAN, title_length INT, snippet_length INT, sentiment_score INT"


def test_summary_of_nothing_is_zero(spark):
    got = aggregates.article_summary(frame(spark, [], ARTICLE)).first()
    assert (got.total_articles, got.companies_covered, got.avg_title_length) == (0, 0, 0.0)
    assert not got.top_companies
    report = aggregates.run_report(frame(spark, [], "n STRING, s STRING, t DOUBLE"), "n", "s", "t").first()
    assert tuple(report) == (0, 0, 0, 0.0, 0.0, 0.0, 0.0)


def test_summary(spark):
    data = [("a", True, False, 4, 2, 1), ("a", False, True, 6, 0, 0), ("b", True, True, 5, 1, -1), (None, True, True, 5, 1, 0)]
    got = aggregates.article_summary(frame(spark, data, ARTICLE), k=1).first()
    assert (got.total_articles, got.companies_covered, got.articles_with_images, got.articles_with_timestamps) == (4, 2, 3, 3)
    assert (got.avg_title_length, got.avg_sentiment_score) == (5.0, 0.0)
    assert [tuple(t) for t in got.top_companies] == [("a", 2)]


def test_run_report_separates_dead_pages(spark):
    # The published sample: 100 pages, all with a name, 8 of them live.
    data = [("ok", 3.6)] * 8 + [("dead", 3.6)] * 92
    df = frame(spark, [("n", s, t) for s, t in data], "n STRING, s STRING, t DOUBLE")
    got = aggregates.run_report(df, "n", "s", "t").first()
    assert (got.raw_success, got.live_success, got.live_success_pct) == (100, 8, 8.0)
    assert got.urls_per_hour == pytest.approx(1000.0)


def test_list_totals_and_profile(spark):
    df = frame(spark, [(["a"], []), ([], []), (["a", "b"], ["u"])], "c ARRAY<STRING>, u ARRAY<STRING>")
    got = aggregates.list_totals(df, ["c", "u"]).first()
    assert (got.total_rows, got.total_c, got.total_u, got.avg_c) == (3, 3, 1, 1.0)
    assert got.hit_rate_pct == pytest.approx(200 / 3)
    profile = aggregates.column_profile(frame(spark, [(1, None), (2, "x")], "a INT, b STRING"))
    assert rows(profile) == [(2, "a", 2, "int"), (2, "b", 1, "string")]


def test_rows_per_seed_keeps_zero(spark):
    got = aggregates.rows_per_seed(frame(spark, [("a",), ("b",)], "k STRING"), frame(spark, [("a",), ("a",)], "k STRING"), "k")
    assert rows(got) == [("a", 2), ("b", 0)]


def test_match_terms(spark):
    docs = frame(
        spark,
        [(1, "Risk & compliance audits"), (2, "risky compliance"), (3, None), (4, "audit, RISK"), (5, "risk compliance c++")],
        "id INT, t STRING",
    )
    listed = ["risk", "risk & compliance", "Compliance audits", "c++", "x\\Ey", ""]
    terms = frame(spark, [(t,) for t in listed], "term STRING")
    got = keywords.match_terms(docs, "id", "t", terms)
    want = [
        (r.id, t) for t in listed if t
        for r in docs.filter(predicates.any_word(F.col("t"), [t], escape=True)).collect()
    ]
    assert sorted(rows(got)) == sorted(want) and len(want) == 6


def test_match_terms_is_linear_in_the_text(spark):
    """The rows that leave the join grow with the words of a text, not with their square."""
    def seconds(n):
        docs = spark.range(8).select("id", F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("w"), i))).alias("t"))
        terms = spark.range(1, n, 2).select(F.concat(F.lit("w"), F.col("id"), F.lit(" w"), F.col("id") + 1).alias("term"))
        start = time.perf_counter()
        assert keywords.match_terms(docs, "id", "t", terms).filter("term = 'w1 w2'").count() == 8
        return time.perf_counter() - start
    seconds(100)
    assert seconds(8000) < 12 * max(1.0, seconds(2000))


def test_join_without_hot_keys_moves_no_copies(spark):
    left = spark.range(100).select("id", (F.col("id") % 50).alias("k"))
    right = left.groupBy("k").agg(F.count("*").alias("n"))
    got = skew.salted_join(left, right, ["k"], ["id"], "left")
    assert "__salt" not in got._jdf.queryExecution().analyzed().toString()
    assert got.columns == ["id", "k", "n"] and sorted(tuple(r) for r in got.collect()) == [(i, i % 50, 2) for i in range(100)]
