"""Inputs derived row by row from the provided tables, in Spark and in SQL.

The tables hold invented text, so the English lexicons rarely hit; where a query needs hits it
passes surrogate words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.workload.registry import spread_table, table

# Surrogate words that occur in the invented text.
FUNDING_WORDS = ("heit", "ment", "tion the")
FEATURE_WORDS = ("tion", "keit", "eau")
POSITIVE_WORDS = ("tion", "the", "que")
NEGATIVE_WORDS = ("und", "re", "aa")
NAME_BY_LANG = {"en": "the", "fr": "que", "de": "und"}

NAME_SQL = "CASE " + " ".join(f"WHEN lang = '{k}' THEN '{v}'" for k, v in NAME_BY_LANG.items()) + " ELSE 'de' END"


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per line of every document; the next line is its snippet."""
    docs = spread_table(spark, sf_dir, "documents", "doc_id", "lang", "source", "text")
    docs = docs.select("doc_id", "lang", "source", F.split("text", "\n").alias("lines"))
    pairs = F.arrays_zip(F.col("lines").alias("title"), F.slice("lines", 2, F.size("lines")).alias("snippet"))
    rows = docs.select("doc_id", "lang", "source", F.posexplode(pairs).alias("line_no", "p"))
    title = F.col("p.title")
    return rows.select(
        (F.col("doc_id") * 1000000 + F.col("line_no")).alias("ord"),
        "doc_id", "lang",
        F.col("source").alias("company"), "source",
        F.expr(NAME_SQL).alias("tool_name"),
        title.alias("title"),
        F.concat(F.lit("/a/"), F.col("doc_id"), F.lit("#"), F.col("line_no")).alias("link"),
        F.when(F.endswith(title, F.lit(".")), F.concat(F.lit("/img/"), F.col("doc_id"))).alias("image_url"),
        F.col("p.snippet").alias("snippet"),
        F.when(F.contains(title, F.lit(",")), F.lit("2024-01-01")).alias("timestamp"),
    )


ARTICLES_SQL = f"""
article_lines AS (
  SELECT doc_id, lang, source, string_split(text, chr(10)) AS ls FROM documents),
article_at AS (
  SELECT doc_id, lang, source, ls, unnest(range(1, len(ls) + 1)) AS i FROM article_lines),
articles AS (
  SELECT doc_id * 1000000 + i - 1 AS ord, doc_id, lang, source AS company, source,
    {NAME_SQL} AS tool_name, ls[i] AS title,
    '/a/' || doc_id || '#' || (i - 1) AS link,
    CASE WHEN ends_with(ls[i], '.') THEN '/img/' || doc_id END AS image_url,
    ls[i + 1] AS snippet,
    CASE WHEN contains(ls[i], ',') THEN '2024-01-01' END AS timestamp
  FROM article_at)
"""


def tag_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue rows with tag cells, one per event; user 5 plays the missing tool_id."""
    e = table(spark, sf_dir, "events")
    return e.selectExpr(
        "event_id AS ord",
        "nullif(user_id, 5) AS tool_id",
        """CASE WHEN event_type = 'signup' THEN NULL ELSE concat(
             CASE WHEN event_type = 'error' THEN ';' ELSE '' END, event_type,
             CASE WHEN value > 10 THEN ';Big' ELSE ';big' END,
             CASE WHEN value < 5 THEN ';;' ELSE '; ' END, event_type) END AS use_original""",
        """CASE WHEN value > 25 THEN NULL ELSE concat(
             CASE WHEN value < 2 THEN ';' ELSE '' END, event_type, ';view;k',
             get_json_object(props, '$.k')) END AS use_aggregated""",
        "CASE WHEN event_type = 'click' THEN concat('Tool ', user_id, '/', event_type) END AS name_tool",
        "CASE WHEN value > 3 THEN concat('https://tool', user_id, '.example.com/') END AS tool_url_y",
        "concat(event_type, ' tool for ', get_json_object(props, '$.k')) AS tool_description",
    )


TAG_CELLS_SQL = """
tag_cells AS (
  SELECT event_id AS ord, nullif(user_id, 5) AS tool_id,
    CASE WHEN event_type = 'signup' THEN NULL ELSE
      (CASE WHEN event_type = 'error' THEN ';' ELSE '' END) || event_type ||
      (CASE WHEN value > 10 THEN ';Big' ELSE ';big' END) ||
      (CASE WHEN value < 5 THEN ';;' ELSE '; ' END) || event_type END AS use_original,
    CASE WHEN value > 25 THEN NULL ELSE
      (CASE WHEN value < 2 THEN ';' ELSE '' END) || event_type || ';view;k' ||
      json_extract_string(props, '$.k') END AS use_aggregated,
    CASE WHEN event_type = 'click' THEN 'Tool ' || user_id || '/' || event_type END AS name_tool,
    CASE WHEN value > 3 THEN 'https://tool' || user_id || '.example.com/' END AS tool_url_y,
    event_type || ' tool for ' || json_extract_string(props, '$.k') AS tool_description
  FROM events)
"""


def escaped(c):
    """Text made safe for the body of a rendered page."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c
