"""Queries over written files, images, known uses and stored answers."""

from __future__ import annotations

import base64
import uuid

from pyspark.sql import functions as F

from gleanwork import lexicons as lx
from gleanwork.operators import aggregates, enrich
from gleanwork.plans import catalog
from gleanwork.session import shared_path
from gleanwork.sources import readers, writers
from gleanwork.workload import views as v
from gleanwork.workload.registry import query, table


@query("""SELECT s AS tool_name, (SELECT count(*) FROM documents WHERE source = s) AS n
FROM (VALUES ('src1'), ('src2'), ('none')) t(s)""")
def inline_seed_rows(spark, sf_dir):
    """Rows per seed of a list given in code, a seed without rows included."""
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("tool_name"))
    return aggregates.rows_per_seed(readers.inline_seeds(spark, ["src1", "src2", "none"]), rows, "tool_name")


@query(f"""SELECT 'image_' || s_name AS name, 'seen ' || (length('{lx.REPORT_HEADING}' || s_name) + 83 + length('n' || s_nationkey) + 1) AS description FROM supplier""")
def image_descriptions(spark, sf_dir):
    """Reports written one file per key, read back as binary payloads and described by a model."""
    path = shared_path(spark, "reports")
    rows = table(spark, sf_dir, "supplier").selectExpr("s_name", "s_name AS key", "concat('n', s_nationkey) AS body")
    writers.write_reports(rows, path, "key", "s_name", "body")
    images = readers.read_images(spark, path, "*.txt")
    described = enrich.describe_images(images, lambda payloads: [f"seen {len(base64.b64decode(p))}" for p in payloads])
    name = F.url_decode(F.regexp_extract("path", "key=([^/]*)/", 1))
    return described.select(F.concat(F.lit("image_"), F.regexp_replace(name, "%20", " ")).alias("name"), "description")


@query("SELECT count(*) AS n, 0::BIGINT AS out_of_order, min(l_extendedprice)::DOUBLE AS first, max(l_extendedprice)::DOUBLE AS last FROM lineitem")
def sorted_file(spark, sf_dir):
    """A CSV table written in order: each part file holds a range, parts follow it by name."""
    path = shared_path(spark, "sorted")
    rows = table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_orderkey", "l_linenumber")
    writers.write_csv(rows, path, ["l_extendedprice", "l_orderkey", "l_linenumber"], order_by=["l_extendedprice", "l_orderkey", "l_linenumber"])
    back = spark.read.schema("p DOUBLE, o BIGINT, l INT").option("header", True).csv(path).select(
        "p", F.regexp_extract(F.col("_metadata.file_name"), "part-([0-9]+)", 1).cast("int").alias("part"), F.monotonically_increasing_id().alias("at"))
    # Ends of each part, one row per part; within a part lines follow each other in `at`.
    ends = back.groupBy("part").agg(F.count("*").alias("n"), F.min("p").alias("low"), F.max("p").alias("high"), F.max_by("p", "at").alias("last"), F.min_by("p", "at").alias("first"))
    inside = F.count_if((F.col("first") != F.col("low")) | (F.col("last") != F.col("high")))
    every = ends.agg(F.array_sort(F.collect_list(F.struct("part", "low", "high"))).alias("parts"), F.sum("n").alias("n"), inside.alias("inside"), F.min("low").alias("first"), F.max("high").alias("last"))
    pairs = F.arrays_zip(F.slice("parts", F.lit(1), F.size("parts") - 1).alias("a"), F.slice("parts", F.lit(2), F.size("parts")).alias("b"))
    between = F.size(F.filter(pairs, lambda x: x["a"]["high"] > x["b"]["low"]))
    return every.select("n", (F.col("inside") + between).cast("long").alias("out_of_order"), "first", "last")


_USES = [w for words in (*lx.ORIGINAL_USE_KEYWORDS.values(), *lx.AGGREGATED_USE_KEYWORDS.values(), *lx.WORD_USE_KEYWORDS.values()) for w in words]
_BOUND = r"[^\p{L}\p{N}_]"


def _case_sql(name: str) -> str:
    if name in lx.WORD_USE_KEYWORDS:
        test = " OR ".join(f"regexp_matches(use_aggregated, '(^|{_BOUND}){w}($|{_BOUND})', 'i')" for w in lx.WORD_USE_KEYWORDS[name])
    else:
        column = "use_original" if name in lx.ORIGINAL_USE_KEYWORDS else "use_aggregated"
        test = " OR ".join(f"contains(lower({column}), '{w}')" for w in (lx.ORIGINAL_USE_KEYWORDS | lx.AGGREGATED_USE_KEYWORDS)[name])
    return f"SELECT '{name}' AS use, count(*) AS n, sum(event_id)::BIGINT AS ids FROM b WHERE {test}"


_BASE_SQL = f"""b AS (SELECT event_id, ({_USES!r})[1 + event_id % {len(_USES)}] AS use_original,
  CASE WHEN event_id % 3 = 0 THEN 'x' ELSE '' END || upper(({_USES!r})[1 + user_id % {len(_USES)}]) AS use_aggregated FROM events)"""


@query(f"WITH {_BASE_SQL} " + " UNION ALL ".join(_case_sql(n) for n in catalog.USE_CASES))
def use_case_cohorts(spark, sf_dir):
    """The known uses over one catalogue: each cohort written to its own table and read back."""
    listed = F.array(*[F.lit(w) for w in _USES])
    pick = lambda c: F.element_at(listed, (F.col(c) % len(_USES) + 1).cast("int"))
    base = table(spark, sf_dir, "events").select(
        "event_id", pick("event_id").alias("use_original"),
        F.concat(F.when(F.col("event_id") % 3 == 0, "x").otherwise(""), F.upper(pick("user_id"))).alias("use_aggregated"))
    root, parts = shared_path(spark, "cohorts"), []
    for i, name in enumerate(catalog.USE_CASES):
        writers.write_cohort(catalog.cohort(base, name), root, f"use{i}")
        rows = spark.read.parquet(f"{root}/use{i}")
        parts.append(rows.agg(F.count("*").alias("n"), F.sum("event_id").alias("ids")).select(F.lit(name).alias("use"), "n", "ids"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(f"""WITH {v.ARTICLES_SQL}, t AS (SELECT title FROM articles WHERE length(trim(title)) >= 10)
SELECT (SELECT count(*) FROM articles) AS n_rows, (SELECT count(*) FROM articles) AS same_answers, (SELECT count(DISTINCT title) FROM t) AS asked""")
def stored_answers(spark, sf_dir):
    """Labels asked twice with one store: the second run gives the first one's answers and asks nothing."""
    store, rows = shared_path(spark, "answers"), v.articles(spark, sf_dir).select("ord", "title")
    once = lambda prompts: [uuid.uuid4().hex for _ in prompts]
    ask = lambda: enrich.enrich_distinct(
        rows, F.when(F.length(F.trim("title")) >= 10, F.col("title")), once, spread_by=["ord"], store=store)
    first = ask().select("ord", F.col("response").alias("a"))
    second = ask().select(F.col("ord").alias("o"), F.col("response").alias("b"))
    both = first.join(second, F.col("ord") == F.col("o"))
    asked = enrich.read_answers(spark, store).agg(F.count("*").alias("asked"))
    same = both.agg(F.count("*").alias("n_rows"), F.count_if(F.col("a").eqNullSafe(F.col("b"))).alias("same_answers"))
    return same.select("n_rows", "same_answers", asked.select("asked").scalar().alias("asked"))


@query(f"""WITH {v.ARTICLES_SQL} SELECT ord, CASE WHEN contains(title, 'q') THEN NULL ELSE 'len ' || length(title) END AS response,
  CASE WHEN contains(title, 'q') THEN 'cannot read this' END AS error FROM articles""")
def enrich_one_bad_prompt(spark, sf_dir):
    """A model that fails on some prompts: its batches are asked in halves until only those are without an answer."""

    def infer(prompts):
        if any("q" in p for p in prompts):
            raise ValueError("cannot read this")
        return [f"len {len(p)}" for p in prompts]

    rows = v.articles(spark, sf_dir).select("ord", "title")
    return enrich.enrich(rows, F.col("title"), infer, in_flight=4).select("ord", "response", "error")
