"""People queries."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from gleanwork import lexicons as lx
from gleanwork import schemas
from gleanwork.functions import responses
from gleanwork.operators import aggregates
from gleanwork.plans import people
from gleanwork.session import shared_path
from gleanwork.sources import readers, writers
from gleanwork.workload.registry import query, spread_table, sql_rate, table

# A free-text affiliation per customer: some blank, some naming several organisations.
_AFFILIATION = """CASE c_mktsegment WHEN 'BUILDING' THEN '  '
  WHEN 'HOUSEHOLD' THEN concat('Research Scientist, Google DeepMind; MIT alumni ', c_name)
  WHEN 'MACHINERY' THEN concat('Professor, University of Toronto & ', n_name)
  WHEN 'FURNITURE' THEN concat('Metadata lead at ', n_name)
  ELSE n_name END"""
_PEOPLE_SQL = "people AS (SELECT c_custkey, c_name AS name, c_mktsegment, " + _AFFILIATION + """ AS affiliation
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _people(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.selectExpr("c_custkey", "c_name AS name", "c_mktsegment", _AFFILIATION + " AS affiliation")


def _found(words) -> str:
    items = ", ".join(f"CASE WHEN contains(lower(affiliation), '{w}') THEN upper('{w[0]}') || '{w[1:]}' END" for w in words)
    return f"CASE WHEN trim(affiliation) = '' THEN [] ELSE list_sort(list_filter([{items}], lambda x: x IS NOT NULL)) END"


_RULES_SQL = f"""WITH {_PEOPLE_SQL}, r AS (SELECT *, {_found(lx.COMPANY_KEYWORDS)} AS companies,
  {_found(lx.UNIVERSITY_KEYWORDS)} AS universities FROM people) """


@query(_RULES_SQL + """SELECT c_custkey, name, affiliation AS original_affiliation, array_to_string(companies, '|') AS companies,
  array_to_string(universities, '|') AS universities,
  CASE WHEN trim(affiliation) = '' THEN 'No affiliation provided' ELSE affiliation END AS primary_affiliation,
  CASE WHEN trim(affiliation) = '' THEN 'Empty affiliation field' ELSE 'Fallback keyword matching' END AS reasoning FROM r""")
def affiliation_rules(spark, sf_dir):
    rows = people.affiliations(_people(spark, sf_dir).drop("c_mktsegment"))
    joined = {c: F.array_join(c, "|") for c in ("companies", "universities")}
    return rows.withColumns(joined)


@query(_RULES_SQL + f"""SELECT count(*) AS total_rows, sum(len(companies))::BIGINT AS total_companies,
  sum(len(universities))::BIGINT AS total_universities, {sql_rate('sum(len(companies))', 'count(*)')} AS avg_companies,
  {sql_rate('sum(len(universities))', 'count(*)')} AS avg_universities,
  {sql_rate('count(*) FILTER (len(companies) > 0 OR len(universities) > 0)', 'count(*)', '100.0')} AS hit_rate_pct FROM r""")
def affiliation_stats(spark, sf_dir):
    return aggregates.list_totals(people.affiliations(_people(spark, sf_dir)), ["companies", "universities"])


_REPLY = """CASE c_mktsegment
  WHEN 'HOUSEHOLD' THEN concat('{"companies": ["', name, '"], "universities": [], "primary_affiliation": "A", "reasoning": "whole"}')
  WHEN 'MACHINERY' THEN concat('Sure! Here it is: {"companies": [], "universities": ["U1", "', name, '"], "primary_affiliation": "B",\n "reasoning": "block"} Hope it helps')
  WHEN 'FURNITURE' THEN '{"companies": "Google", "universities": [], "primary_affiliation": "C", "reasoning": "wrong type"}'
  ELSE 'I do not know' END"""


@query(f"""WITH {_PEOPLE_SQL} SELECT c_custkey,
  CASE c_mktsegment WHEN 'HOUSEHOLD' THEN name ELSE '' END AS companies,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'U1|' || name ELSE '' END AS universities,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'No affiliation provided' WHEN 'HOUSEHOLD' THEN 'A' WHEN 'MACHINERY' THEN 'B' ELSE affiliation END AS primary_affiliation,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Empty affiliation field' WHEN 'HOUSEHOLD' THEN 'whole' WHEN 'MACHINERY' THEN 'block'
    ELSE 'Fast fallback - LLM extraction failed' END AS reasoning FROM people""")
def response_recover(spark, sf_dir):
    rows = _people(spark, sf_dir).withColumn(
        "r", responses.affiliation_or_fallback(F.expr(_REPLY), F.col("affiliation"))
    )
    return rows.select(
        "c_custkey", F.array_join("r.companies", "|").alias("companies"),
        F.array_join("r.universities", "|").alias("universities"), "r.primary_affiliation", "r.reasoning",
    )


def _stand_in(prompts):
    return [
        json.dumps({"companies": ["C" + str(p.count("a"))], "universities": [], "primary_affiliation": "M", "reasoning": "model"})
        if "Professor" in p else "no idea"
        for p in prompts
    ]


@query(f"""WITH {_PEOPLE_SQL} SELECT primary_affiliation, reasoning, count(*) AS n FROM (
  SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'No affiliation provided' WHEN 'MACHINERY' THEN 'M' ELSE affiliation END AS primary_affiliation,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'Empty affiliation field' WHEN 'MACHINERY' THEN 'model' ELSE 'Fast fallback - LLM extraction failed' END AS reasoning
  FROM people) GROUP BY ALL""")
def affiliation_by_model(spark, sf_dir):
    rows = people.affiliations(_people(spark, sf_dir), infer=_stand_in, spread_by=["c_custkey"])
    return rows.groupBy("primary_affiliation", "reasoning").agg(F.count("*").alias("n"))


# One listing page per customer; the segment decides the markup that is missing.
_CARD = """concat('<html><body><div class="', CASE WHEN c_mktsegment = 'FURNITURE' THEN 'x gsc_1usr_wide' ELSE 'gsc_1usr' END, '">',
  '<img src="/i/', c_custkey, '.png" alt="', c_name, '">',
  CASE WHEN c_mktsegment = 'MACHINERY' THEN concat('<a href="/c?u=', c_custkey, '"> ', c_name, ' </a>')
    ELSE concat('<h3 class="gs_ai_name"><a href="/c?u=', c_custkey, '">', c_name, '</a></h3>') END,
  CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE concat('<div class="gs_ai_aff">Dept. of', chr(7), ' <b>', c_mktsegment, '</b></div>') END,
  '<div class="gs_ai_eml">Verified email at n', c_nationkey, '.example.com</div>',
  CASE WHEN c_acctbal > 5000 THEN concat('<div class="gs_ai_cby">Cited by ', c_custkey, '</div>') ELSE '' END,
  '<div class="gs_ai_int">', CASE WHEN c_acctbal > 0 THEN '<a class="gs_ai_one_int">AI</a> <a class="gs_ai_one_int">Robots</a>' ELSE '' END,
  '</div></div></body></html>') AS html"""


def _listing(spark, sf_dir):
    rows = spread_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey", "c_acctbal")
    return rows.selectExpr(
        "c_custkey", "c_mktsegment AS label", "cast(c_nationkey AS int) AS tab_index", "1 AS page_number", _CARD
    )


_EML = "'Verified email at n' || c_nationkey || '.example.com'"
_CBY = "CASE WHEN c_acctbal > 5000 THEN 'Cited by ' || c_custkey ELSE 'N/A' END"


@query(f"""SELECT c_custkey, c_name AS name, 'https://scholar.google.com/c?u=' || c_custkey AS profile_url,
  CASE WHEN c_mktsegment = 'BUILDING' THEN {_EML} ELSE 'Dept. of' || c_mktsegment END AS affiliation,
  {_EML} AS email, {_CBY} AS citations, CASE WHEN c_acctbal > 0 THEN 'AI, Robots' ELSE 'N/A' END AS research_interests,
  '/i/' || c_custkey || '.png' AS image_url FROM customer""")
def profile_cards(spark, sf_dir):
    """Without an affiliation element the first div holding plain text stands in, as published."""
    return people.profile_rows(_listing(spark, sf_dir).select("c_custkey", "html")).drop("pos")


@query(f"""SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'N/A' ELSE c_name END AS name,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'N/A' ELSE '/c?u=' || c_custkey END AS profile_url,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'N/A' ELSE 'Dept. of' || chr(7) || ' ' || c_mktsegment END AS affiliation,
  {_EML} AS email, {_CBY} AS citations, CASE WHEN c_acctbal > 0 THEN 'AI; Robots' ELSE '' END AS interests,
  '/i/' || c_custkey || '.png' AS profile_picture_url, c_name AS profile_picture_alt, c_mktsegment AS label,
  c_nationkey::INTEGER AS tab_index, 1 AS page_number, '2024-01-01' AS scraped_at
FROM customer WHERE c_mktsegment <> 'FURNITURE'""")
def profile_cards_labelled(spark, sf_dir):
    return people.labelled_profile_rows(_listing(spark, sf_dir), "'2024-01-01'").drop("pos")


@query("""WITH a AS (SELECT c_name AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE 'Dept. of' || c_mktsegment END AS affiliation FROM customer)
SELECT name, affiliation AS original_affiliation, coalesce(affiliation, 'No affiliation provided') AS primary_affiliation,
  CASE WHEN affiliation IS NULL THEN 'Empty affiliation field' ELSE 'Fallback keyword matching' END AS reasoning FROM a""")
def people_run(spark, sf_dir):
    """End to end: listing pages to affiliations; a card without any affiliation text counts as blank."""
    pages = _listing(spark, sf_dir).select(
        F.regexp_replace("html", '<div class="gs_ai_eml">.*?</div>', "").alias("html"), "label", "c_custkey"
    )
    bare = F.regexp_replace("html", '<div class="gs_ai_cby">.*?</div>', "")
    rows = people.people_run(pages.select(bare.alias("html")))
    return rows.select("name", "original_affiliation", "primary_affiliation", "reasoning")


@query("""SELECT label, count(*) AS n, count(*) FILTER (aff IS NULL) AS blank, count(*) FILTER (name IS NULL) AS unnamed FROM (
  SELECT c_mktsegment AS label, CASE WHEN c_mktsegment <> 'BUILDING' THEN 1 END AS aff,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN 1 END AS name FROM customer WHERE c_mktsegment <> 'FURNITURE') GROUP BY label""")
def people_file(spark, sf_dir):
    """Collected profiles written with the fixed columns; the `N/A` texts read back as missing."""
    rows = people.labelled_profile_rows(_listing(spark, sf_dir), "'2024-01-01'")
    path = shared_path(spark, "profiles")
    writers.write_csv(rows, path, lx.SCIENTIST_FIELDS)
    back = readers.read_csv(spark, path, schemas.SCIENTIST)
    found = people.affiliations(back.select("label", "name", "affiliation"))
    return found.groupBy("label").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("primary_affiliation") == lx.NO_AFFILIATION).alias("blank"),
        F.count_if(F.col("name").isNull()).alias("unnamed"),
    )
