"""Catalogue queries."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from gleanwork import lexicons as lx
from gleanwork.functions import predicates, responses, tags
from gleanwork.operators import aggregates, dedup, enrich, joins, ordinals
from gleanwork.plans import catalog
from gleanwork.workload import views as v
from gleanwork.workload.registry import query, spread_table, sql_strip, table

_CELLS = f"WITH {v.TAG_CELLS_SQL} "


def _ranking(spark, sf_dir):
    """lineitem as the ranking: many rows per tool, part 5 plays the missing key."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS ord", "nullif(l_partkey, 5) AS tool_id",
        "concat(l_returnflag, ';', l_linestatus) AS use_original",
        "concat('https://rank.example.com/', l_suppkey) AS tool_url",
    )


def _profile(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(
        "nullif(p_partkey, 5) AS tool_id", "p_name AS name_tool",
        "concat(p_type, ';', replace(p_name, ' ', ';')) AS use_aggregated",
        "concat('https://tool.example.com/', p_partkey) AS tool_url", "p_brand AS tool_description",
    )


_MERGE_SQL = """
WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS ord, nullif(l_partkey, 5) AS tool_id,
  l_returnflag || ';' || l_linestatus AS use_original, 'https://rank.example.com/' || l_suppkey AS tool_url FROM lineitem),
p AS (SELECT nullif(p_partkey, 5) AS tool_id, p_name AS name_tool,
  p_type || ';' || replace(p_name, ' ', ';') AS use_aggregated,
  'https://tool.example.com/' || p_partkey AS tool_url, p_brand AS tool_description FROM part),
m AS (SELECT r.ord, r.tool_id, r.use_original, p.use_aggregated, p.name_tool, r.tool_url AS tool_url_x,
  p.tool_url AS tool_url_y, p.tool_description FROM r JOIN p ON r.tool_id IS NOT DISTINCT FROM p.tool_id)
"""


@query(_MERGE_SQL + "SELECT * FROM m")
def catalog_merge_nullsafe(spark, sf_dir):
    return joins.merge(_ranking(spark, sf_dir), _profile(spark, sf_dir), "tool_id", spread_by=["ord"], right_spread_by=["tool_url"])


@query(_MERGE_SQL + "SELECT * FROM m WHERE tool_id IS NOT NULL")
def catalog_merge_drop_nulls(spark, sf_dir):
    return joins.merge(_ranking(spark, sf_dir), _profile(spark, sf_dir), "tool_id", null_keys="drop", spread_by=["ord"])


@query(_MERGE_SQL + "SELECT use_original, use_aggregated, count(*) AS n FROM m GROUP BY ALL")
def catalog_columns(spark, sf_dir):
    rows = catalog.catalogue(_ranking(spark, sf_dir), _profile(spark, sf_dir), spread_by=["ord"])
    return rows.groupBy("use_original", "use_aggregated").agg(F.count("*").alias("n"))


@query(f"SELECT count(*) FILTER (ends_with(lower({sql_strip('p_name')}), 'et')) AS n FROM part")
def suffix_count(spark, sf_dir):
    return aggregates.count_where(table(spark, sf_dir, "part"), predicates.has_suffix(F.col("p_name"), "ET".lower()))


@query(_CELLS + "SELECT ord FROM tag_cells WHERE use_original IS NULL OR use_aggregated IS NULL OR use_original <> use_aggregated")
def columns_differ(spark, sf_dir):
    rows = v.tag_cells(spark, sf_dir)
    return rows.filter(predicates.differs(F.col("use_original"), F.col("use_aggregated"))).select("ord")


# --- cohorts ---------------------------------------------------------------------------------


def _tagged(spark, sf_dir, word):
    rows = v.tag_cells(spark, sf_dir)
    return rows, rows.filter(predicates.any_keyword(F.col("use_aggregated"), [word]))


@query(_CELLS + """SELECT ord FROM tag_cells WHERE contains(use_aggregated, 'purchase')
  OR tool_id IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000) AND NOT contains(coalesce(use_aggregated, ''), 'purchase')""")
def cohort_or_listed(spark, sf_dir):
    """A keyword cohort united with the rows of listed ids that the keyword missed."""
    rows, cohort = _tagged(spark, sf_dir, "PURCHASE")
    ids = table(spark, sf_dir, "orders").filter("o_totalprice > 100000").select(F.col("o_custkey").alias("tool_id"))
    rest = joins.members(joins.non_members(rows, cohort, "ord"), ids, "tool_id")
    return dedup.union_all(cohort, rest).select("ord")


@query(_CELLS + """, c AS (SELECT DISTINCT tool_id FROM tag_cells WHERE contains(use_aggregated, 'k9'))
SELECT ord, tool_id FROM tag_cells t WHERE EXISTS (SELECT 1 FROM c WHERE c.tool_id IS NOT DISTINCT FROM t.tool_id)""")
def cohort_members(spark, sf_dir):
    rows, cohort = _tagged(spark, sf_dir, "k9")
    return joins.members(rows, cohort, "tool_id", spread_by=["ord"]).select("ord", "tool_id")


@query(_CELLS + """, c AS (SELECT DISTINCT tool_id FROM tag_cells WHERE contains(use_aggregated, 'k99'))
SELECT ord, tool_id FROM tag_cells t WHERE contains(tool_description, 'click')
  AND NOT EXISTS (SELECT 1 FROM c WHERE c.tool_id IS NOT DISTINCT FROM t.tool_id)""")
def candidates_anti(spark, sf_dir):
    rows, cohort = _tagged(spark, sf_dir, "k99")
    found = rows.filter(predicates.any_keyword(F.col("tool_description"), ["click"]))
    return joins.non_members(found, cohort, "tool_id", spread_by=["ord"]).select("ord", "tool_id")


@query("""WITH b AS (SELECT nullif(p_partkey, 5) AS tool_id, p_name, p_size FROM part),
c AS (SELECT * FROM b WHERE p_size > 40),
ids AS (SELECT DISTINCT nullif(l_partkey, 5) AS tool_id FROM lineitem WHERE l_quantity >= 50),
m AS (SELECT tool_id FROM ids WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.tool_id IS NOT DISTINCT FROM ids.tool_id))
SELECT * FROM c UNION ALL
SELECT b.* FROM b WHERE EXISTS (SELECT 1 FROM m WHERE m.tool_id IS NOT DISTINCT FROM b.tool_id)""")
def add_missing_ids(spark, sf_dir):
    base = table(spark, sf_dir, "part").selectExpr("nullif(p_partkey, 5) AS tool_id", "p_name", "p_size")
    ids = table(spark, sf_dir, "lineitem").filter("l_quantity >= 50").selectExpr("nullif(l_partkey, 5) AS tool_id")
    return joins.add_missing_ids(base.filter("p_size > 40"), base, ids, "tool_id")


@query("""WITH d AS (SELECT n_regionkey AS name, n_nationkey AS tool_id, n_name AS tool_url FROM nation
  QUALIFY row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey DESC) = 1)
SELECT c_custkey, d.tool_id, d.tool_url FROM customer LEFT JOIN d ON c_nationkey = d.name""")
def lookup_last_wins(spark, sf_dir):
    dim = table(spark, sf_dir, "nation").selectExpr("n_regionkey AS name", "n_nationkey AS tool_id", "n_name AS tool_url")
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    found = joins.lookup_last(people, dim, "c_nationkey", ["tool_id", "tool_url"], "tool_id", dim_key="name", spread_by=["c_custkey"])
    return found.select("c_custkey", "tool_id", "tool_url")


_EDIT_CLEAN = sql_strip("trim(coalesce(use_aggregated, chr(59)), ';')")
_ADD_SQL = f"""CASE WHEN list_contains(string_split(lower({_EDIT_CLEAN}), ';'), 'k7') THEN {_EDIT_CLEAN}
  WHEN {_EDIT_CLEAN} <> '' THEN {_EDIT_CLEAN} || ';k7' ELSE 'k7' END"""


@query(_CELLS + f""", c AS (SELECT DISTINCT tool_id FROM tag_cells WHERE contains(use_original, 'purchase;Big'))
SELECT ord, tool_id, CASE WHEN EXISTS (SELECT 1 FROM c WHERE c.tool_id IS NOT DISTINCT FROM t.tool_id)
  THEN {_ADD_SQL} ELSE use_aggregated END AS use_aggregated FROM tag_cells t""")
def update_from(spark, sf_dir):
    rows = v.tag_cells(spark, sf_dir)
    cohort = rows.filter(predicates.any_keyword(F.col("use_original"), ["purchase;Big"], case_sensitive=True))
    return catalog.add_tag_to(rows, cohort, "k7", ["ord"]).select("ord", "tool_id", "use_aggregated")


# --- tags ------------------------------------------------------------------------------------


@query(_CELLS + f"SELECT ord, {_ADD_SQL} AS use_aggregated FROM tag_cells")
def tag_add(spark, sf_dir):
    return v.tag_cells(spark, sf_dir).select("ord", tags.add_tag(F.col("use_aggregated"), "k7").alias("use_aggregated"))


def _remove_sql(column: str, words) -> str:
    expr = column
    for w in words:
        for piece in (f";{w}", f"{w};", w):
            expr = f"replace({expr}, '{piece}', '')"
    return sql_strip(f"trim(replace({expr}, ';;', ';'), ';')")


@query(_CELLS + f"""SELECT ord, {_remove_sql('use_original', ['view', 'Big'])} AS use_original,
  {_remove_sql('use_aggregated', ['k1', 'error'])} AS use_aggregated FROM tag_cells""")
def tag_remove(spark, sf_dir):
    return v.tag_cells(spark, sf_dir).select(
        "ord",
        tags.remove_keywords(F.col("use_original"), ["view", "Big"]).alias("use_original"),
        tags.remove_keywords(F.col("use_aggregated"), ["k1", "error"]).alias("use_aggregated"),
    )


@query(_CELLS + f"""SELECT ord, CASE WHEN tool_id IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)
  THEN {_remove_sql('use_aggregated', ['view'])} ELSE use_aggregated END AS use_aggregated FROM tag_cells""")
def tag_remove_listed(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("tool_id"))
    return catalog.remove_tags(v.tag_cells(spark, sf_dir), ["view"], ids, ["ord"]).select("ord", "use_aggregated")


def _list_sql(column: str) -> str:
    return (
        f"list_filter(list_transform(string_split(coalesce({column}, ''), ';'), "
        f"lambda x: {sql_strip('x')}), lambda x: x <> '')"
    )


@query(_CELLS + f""", l AS (SELECT ord, use_original, contains(tool_description, '4') AS relevant, {_list_sql('use_original')} AS a FROM tag_cells)
SELECT ord, array_to_string(a, '|') AS listed, CASE WHEN starts_with(use_original, ';') THEN ';' ELSE '' END ||
  array_to_string(CASE WHEN relevant THEN CASE WHEN list_contains(a, 'click') THEN a ELSE list_append(a, 'click') END
    ELSE list_filter(a, lambda x: x <> 'click') END, ';') AS use_original FROM l""")
def tag_upsert(spark, sf_dir):
    cell = F.col("use_original")
    relevant = F.contains(F.col("tool_description"), F.lit("4"))
    return v.tag_cells(spark, sf_dir).select(
        "ord", F.array_join(tags.to_list(cell), "|").alias("listed"),
        tags.upsert_tag(cell, "click", relevant).alias("use_original"),
    )


@query(_CELLS + "SELECT ord, replace(use_original, 'view', 'page view') AS use_original FROM tag_cells")
def tag_rename(spark, sf_dir):
    return v.tag_cells(spark, sf_dir).select("ord", tags.rename_tag(F.col("use_original"), "view", "page view").alias("use_original"))


def _merge_tags_sql(column: str) -> str:
    return f"""(SELECT tool_id, string_agg(tag, ';' ORDER BY seen) AS {column} FROM (
      SELECT tool_id, tag, min(ord * 1000 + pos) AS seen FROM (
        SELECT tool_id, ord, {sql_strip('s[pos]')} AS tag, pos FROM (
          SELECT tool_id, ord, s, unnest(range(1, len(s) + 1)) AS pos FROM (
            SELECT tool_id, ord, string_split({column}, ';') AS s FROM tag_cells
            WHERE tool_id IS NOT NULL AND {column} IS NOT NULL)))
      WHERE tag <> '' GROUP BY tool_id, tag) GROUP BY tool_id)"""


@query(_CELLS + f"SELECT tool_id, use_aggregated FROM {_merge_tags_sql('use_aggregated')}")
def tag_merge(spark, sf_dir):
    return aggregates.merge_tags(v.tag_cells(spark, sf_dir), "tool_id", ["use_aggregated"], "ord")


def _first_sql(column: str) -> str:
    return f"arg_min({column}, ord) FILTER ({column} IS NOT NULL) AS {column}"


@query(_CELLS + f"""SELECT f.*, coalesce(o.use_original, '') AS use_original, coalesce(a.use_aggregated, '') AS use_aggregated
FROM (SELECT tool_id, {_first_sql('name_tool')}, {_first_sql('tool_url_y')}, {_first_sql('tool_description')}
  FROM tag_cells WHERE tool_id IS NOT NULL GROUP BY tool_id) f
LEFT JOIN {_merge_tags_sql('use_original')} o USING (tool_id)
LEFT JOIN {_merge_tags_sql('use_aggregated')} a USING (tool_id)""")
def one_per_tool(spark, sf_dir):
    return catalog.merged_tools(v.tag_cells(spark, sf_dir), "ord")


_VIDEO = enrich.UseCase("clicking", "click", ("click", "k9"))


@query(_CELLS + f""", edited AS (SELECT ord, tool_id, CASE WHEN regexp_matches(lower(use_aggregated), '{predicates.word_pattern(_VIDEO.keywords)}')
    THEN CASE WHEN starts_with(use_aggregated, ';') THEN ';' ELSE '' END || array_to_string(
      CASE WHEN regexp_matches(lower(tool_description), '{predicates.word_pattern(_VIDEO.keywords)}')
        THEN CASE WHEN list_contains({_list_sql('use_aggregated')}, 'click') THEN {_list_sql('use_aggregated')} ELSE list_append({_list_sql('use_aggregated')}, 'click') END
        ELSE list_filter({_list_sql('use_aggregated')}, lambda x: x <> 'click') END, ';')
    ELSE use_aggregated END AS use_aggregated FROM tag_cells)
SELECT tool_id, use_aggregated FROM {_merge_tags_sql('use_aggregated').replace('tag_cells', 'edited')}""")
def curate_and_merge(spark, sf_dir):
    """End to end: curate a use, write the cells back row by row, one record per tool."""
    return catalog.curate_and_merge(v.tag_cells(spark, sf_dir), _VIDEO, "ord").select("tool_id", "use_aggregated")


# --- duplicates ------------------------------------------------------------------------------


@query(_CELLS + """, c AS (SELECT tool_id, count(*) AS n FROM tag_cells GROUP BY tool_id)
SELECT sum(n)::BIGINT AS total_rows, count(tool_id) AS distinct_keys, (sum(n) - count(tool_id))::BIGINT AS surplus_rows,
  count(*) FILTER (tool_id IS NOT NULL AND n > 1) AS repeated_keys,
  max(n) FILTER (tool_id IS NOT NULL AND n > 1) AS max_repeats FROM c""")
def dup_overview(spark, sf_dir):
    return aggregates.duplicate_overview(v.tag_cells(spark, sf_dir), "tool_id")


_TOP_KEYS = """, k AS (SELECT tool_id, count(*) AS n FROM tag_cells WHERE tool_id IS NOT NULL
  GROUP BY tool_id HAVING count(*) > 1 ORDER BY n DESC, tool_id LIMIT 10)"""


@query(_CELLS + _TOP_KEYS + """SELECT tool_id, arg_min_null(name_tool, ord) AS name_tool, n,
  count(DISTINCT use_original) AS distinct_use_original, count(DISTINCT use_aggregated) AS distinct_use_aggregated
FROM tag_cells JOIN k USING (tool_id) GROUP BY tool_id, n""")
def dup_explain(spark, sf_dir):
    rows = v.tag_cells(spark, sf_dir)
    return aggregates.explain_duplicates(rows, "tool_id", "name_tool", ["use_original", "use_aggregated"], "ord", 10)


@query(_CELLS + _TOP_KEYS + """, x AS (SELECT DISTINCT tool_id, 'use_original' AS "column", use_original AS value
  FROM tag_cells JOIN k USING (tool_id) WHERE use_original IS NOT NULL
  UNION SELECT DISTINCT tool_id, 'use_aggregated', use_aggregated FROM tag_cells JOIN k USING (tool_id) WHERE use_aggregated IS NOT NULL)
SELECT *, count(*) OVER (PARTITION BY tool_id, "column") AS n_values FROM x QUALIFY n_values > 1""")
def dup_values(spark, sf_dir):
    rows = v.tag_cells(spark, sf_dir)
    return aggregates.conflicting_values(rows, "tool_id", ["use_original", "use_aggregated"], 10)


@query(_CELLS + _TOP_KEYS.replace("LIMIT 10", "LIMIT 5") + "SELECT tool_id, n, ord, name_tool, use_original FROM tag_cells JOIN k USING (tool_id)")
def dup_rows(spark, sf_dir):
    rows = v.tag_cells(spark, sf_dir).select("tool_id", "ord", "name_tool", "use_original")
    return aggregates.repeated_rows(rows, "tool_id", 5)


@query(_CELLS + "SELECT (SELECT count(*) FROM tag_cells) - (SELECT count(*) FROM (SELECT DISTINCT tool_id, use_original FROM tag_cells)) AS exact_duplicates")
def dup_exact(spark, sf_dir):
    return aggregates.exact_duplicate_count(v.tag_cells(spark, sf_dir), ["tool_id", "use_original"])


@query("SELECT l_partkey, l_suppkey, min(l_orderkey * 10 + l_linenumber) AS ord FROM lineitem GROUP BY ALL")
def keep_first(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_partkey", "l_suppkey", "l_orderkey * 10 + l_linenumber AS ord")
    return dedup.keep_first(rows, ["l_partkey", "l_suppkey"], ["ord"])


@query(_CELLS + "SELECT min(ord) AS ord, tool_id, use_original FROM tag_cells GROUP BY tool_id, use_original")
def unique_uses(spark, sf_dir):
    return catalog.unique_uses(v.tag_cells(spark, sf_dir), "ord").select("ord", "tool_id", "use_original")


@query(_CELLS + "SELECT min(ord) AS ord, tool_id FROM tag_cells GROUP BY tool_id")
def first_per_tool(spark, sf_dir):
    return catalog.first_per_tool(v.tag_cells(spark, sf_dir), "ord").select("ord", "tool_id")


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 5")
def top_k(spark, sf_dir):
    return aggregates.top_k(table(spark, sf_dir, "lineitem"), "l_partkey", 5)


@query("SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey HAVING count(*) > 1")
def repeated_keys(spark, sf_dir):
    return aggregates.repeated_keys(table(spark, sf_dir, "lineitem"), "l_suppkey")


@query("SELECT p_partkey, p_name FROM part ORDER BY md5(p_partkey || '#7'), p_partkey LIMIT 25")
def repeatable_sample(spark, sf_dir):
    return ordinals.repeatable_sample(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey", 25, seed=7)


@query("""WITH j AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)),
c AS (SELECT count(*) AS total_rows, unnest([
  {'c': 'doc_id', 'n': count(doc_id), 't': 'bigint'}, {'c': 'lang', 'n': count(lang), 't': 'string'},
  {'c': 'text', 'n': count(text), 't': 'string'}, {'c': 'quality', 'n': count(quality), 't': 'int'},
  {'c': 'toxic', 'n': count(toxic), 't': 'int'}]) AS x FROM j)
SELECT total_rows, x.c AS "column", x.n AS non_null, x.t AS dtype FROM c""")
def column_profile(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id", "cast(quality AS int) quality", "cast(toxic AS int) toxic")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return aggregates.column_profile(docs.join(labels, "doc_id", "left"))


# --- verdicts --------------------------------------------------------------------------------


def _doc_catalog(spark, sf_dir):
    """Documents as catalogue rows: language and source are the tags, the text describes."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS tool_id", "concat(';', lang, '; ', source) AS use_aggregated", "text AS tool_description"
    )


_CASE = enrich.UseCase("french writing", "french", ("fr", "que le", "the by"))
_WORD_TEST = predicates.word_pattern(_CASE.keywords)
_DOC_CATALOG_SQL = f"""WITH b AS (SELECT doc_id AS tool_id, ';' || lang || '; ' || source AS use_aggregated,
  text AS tool_description, regexp_matches(lower(';' || lang || '; ' || source), '{_WORD_TEST}') AS in_tags,
  regexp_matches(lower(text), '{_WORD_TEST}') AS in_text FROM documents) """


@query(_DOC_CATALOG_SQL + """SELECT tool_id, in_text AS relevant,
  CASE WHEN in_text THEN 'keyword in description' END AS reason,
  CASE WHEN in_text THEN ';' || trim(string_split(use_aggregated, ';')[2]) || ';' || trim(string_split(use_aggregated, ';')[3]) || ';french'
    ELSE ';' || trim(string_split(use_aggregated, ';')[2]) || ';' || trim(string_split(use_aggregated, ';')[3]) END AS use_aggregated
FROM b WHERE in_tags""")
def curate_cohort(spark, sf_dir):
    cohort, _ = enrich.curate(_doc_catalog(spark, sf_dir), _CASE, "tool_id", enrich.judged_by(_CASE))
    return cohort.select("tool_id", "relevant", "reason", "use_aggregated")


@query(_DOC_CATALOG_SQL + "SELECT tool_id FROM b WHERE in_text AND NOT in_tags")
def curate_candidates(spark, sf_dir):
    _, candidates = enrich.curate(_doc_catalog(spark, sf_dir), _CASE, "tool_id", enrich.judged_by(_CASE))
    return candidates.select("tool_id")


def _use_model(prompts):
    return [json.dumps({"relevant": p.count("e") > 200, "reason": None}) for p in prompts]


@query(_DOC_CATALOG_SQL + f""", n AS (SELECT *, length(tool_description) - length(replace(tool_description, 'e', '')) AS n_e FROM b WHERE in_tags)
SELECT tool_id, n_e + (length(q) - length(replace(q, 'e', ''))) > 200 AS relevant, NULL::VARCHAR AS reason FROM n,
  (SELECT '{lx.USE_PROMPT.replace('{use}', 'french writing').replace('{desc}', '').replace(chr(39), chr(39) * 2)}' AS q)""")
def curate_by_model(spark, sf_dir):
    judge = enrich.judged_by(_CASE, _use_model)
    cohort, _ = enrich.curate(_doc_catalog(spark, sf_dir), _CASE, "tool_id", judge)
    return cohort.select("tool_id", "relevant", "reason")


@query(f"""SELECT d.doc_id, contains(lower(text), 'tion the') OR coalesce(quality = 1 AND toxic = 0, false) AS relevant,
  CASE WHEN contains(lower(text), 'tion the') THEN 'phrase found'
    WHEN quality IS NULL THEN 'phrase missing' WHEN quality = 1 AND toxic = 0 THEN 'label ' || quality || '/' || toxic
    ELSE 'phrase missing{lx.CHECKED_SUFFIX}' END AS reason,
  NOT contains(lower(text), 'tion the') AND quality IS NOT NULL AS verified
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def two_pass_verdict(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hit = predicates.any_keyword(F.col("text"), ["tion the"])
    first = F.struct(hit.alias("relevant"), F.when(hit, "phrase found").otherwise("phrase missing").alias("reason"))
    evidence = table(spark, sf_dir, "labels").selectExpr(
        "doc_id", "quality = 1 AND toxic = 0 AS supports", "concat('label ', quality, '/', toxic) AS evidence"
    )
    return enrich.two_pass_verdict(docs, first, evidence, "doc_id").drop("text")


@query("""SELECT '[' || string_agg('{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","ring":true}', ',' ORDER BY p_partkey) || ']' AS payload
FROM (SELECT * FROM part WHERE contains(lower(p_name), 'ring') ORDER BY p_partkey LIMIT 10)""")
def prompt_payload(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return enrich.payload(enrich.flag_use(parts, "ring", "p_name", "ring"), "p_partkey", 10)


# --- responses -------------------------------------------------------------------------------

# Every event becomes a collected answer; its type decides what is wrong with it.
_ANSWER = """CASE event_type
  WHEN 'view' THEN '{"category": "funding", "company_relevance": true, "reasoning": "k' || k || '", "extra": 1}'
  WHEN 'click' THEN '{"category": "news article", "company_relevance": "No", "reasoning": "k' || k || '"}'
  WHEN 'purchase' THEN '{"category": "weather", "company_relevance": true, "reasoning": "k"}'
  WHEN 'signup' THEN '{"category": "irrelevant", "company_relevance": false}'
  ELSE '{"category": "funding", "company_relevance": true, "reasoning": "k"} k' || k END"""
_EVENTS_K = "(SELECT *, json_extract_string(props, '$.k') AS k FROM events)"


def _answers(spark, sf_dir):
    e = spread_table(spark, sf_dir, "events", "event_id", "event_type", "props").withColumn("k", F.get_json_object("props", "$.k"))
    return e.withColumn("content", F.expr(_ANSWER))


@query(f"""SELECT event_id, event_type IN ('view', 'click') AS valid,
  CASE event_type WHEN 'view' THEN 'funding' WHEN 'click' THEN 'news article' END AS category,
  CASE event_type WHEN 'view' THEN true WHEN 'click' THEN false END AS company_relevance,
  CASE WHEN event_type IN ('view', 'click') THEN 'k' || k END AS reasoning FROM {_EVENTS_K}""")
def response_validate(spark, sf_dir):
    rows = _answers(spark, sf_dir).withColumn("r", responses.parse_article_class(F.col("content")))
    return rows.select(
        "event_id", F.col("r").isNotNull().alias("valid"), "r.category", "r.company_relevance", "r.reasoning"
    )


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY event_type")
def response_quarantine(spark, sf_dir):
    rows = _answers(spark, sf_dir).withColumn("r", responses.parse_article_class(F.col("content")))
    _, bad = responses.split_valid(rows, "r")
    return bad.groupBy("event_type").agg(F.count("*").alias("n"))


_EVIDENCE = """CASE event_type
  WHEN 'view' THEN '{"supports": ' || k || ', "evidence": "seen ' || k || '"}'
  WHEN 'click' THEN '{"supports": "", "evidence": ' || k || '}'
  WHEN 'purchase' THEN '{"supports": "false", "evidence": null}'
  WHEN 'signup' THEN '{"supports": true}' ELSE 'no answer ' || k END"""


@query(f"""SELECT event_id, CASE event_type WHEN 'view' THEN k <> '0' WHEN 'click' THEN false WHEN 'purchase' THEN true END AS supports,
  CASE event_type WHEN 'view' THEN 'seen ' || k WHEN 'click' THEN k WHEN 'purchase' THEN 'None' END AS evidence FROM {_EVENTS_K}""")
def evidence_validate(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    return e.withColumn("r", responses.parse_evidence(F.expr(_EVIDENCE))).select("event_id", "r.supports", "r.evidence")


_DEFINITION = """CASE lang
  WHEN 'en' THEN '[{"meanings": [{"definitions": [{"definition": ' || quoted || '}]}]}]'
  WHEN 'fr' THEN '[{"meanings": []}, ' || quoted || ']'
  WHEN 'de' THEN '[]' ELSE '{"title": ' || quoted || '}' END"""


@query("""SELECT doc_id, CASE WHEN source = 'src3' THEN 'Error: 404 - ' || source WHEN lang = 'en' THEN text
  WHEN lang = 'fr' THEN 'No definition found.' ELSE 'Error parsing definition.' END AS definition FROM documents""")
def definition_path(spark, sf_dir):
    docs = spread_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    quoted = F.regexp_extract(F.to_json(F.struct(F.col("text").alias("t"))), r'(?s)^\{"t":(.*)\}$', 1)
    body = F.when(F.col("source") == "src3", F.col("source")).otherwise(F.expr(_DEFINITION))
    status = F.when(F.col("source") == "src3", 404).otherwise(200)
    return docs.withColumn("quoted", quoted).select("doc_id", responses.definition_text(status, body).alias("definition"))
