"""Crawl queries."""

from __future__ import annotations

import gzip
from datetime import timedelta

from pyspark.sql import functions as F

from gleanwork import lexicons as lx
from gleanwork import schemas
from gleanwork.functions import predicates, text, urls
from gleanwork.operators import aggregates, dedup, extract, joins, ordinals
from gleanwork.plans import crawl
from gleanwork.session import shared_path
from gleanwork.sources import batches, files, readers, writers
from gleanwork.sources import ledger as ledgers
from gleanwork.streaming import crawl as streams
from gleanwork.streaming import runs
from gleanwork.workload import views as v
from gleanwork.workload.registry import query, spread_table, sql_rate, table

# --- frontier, shards, merging ---------------------------------------------------------------

# The crawl ledger: an order is a URL; finished orders are done, pending ones failed.
_LEDGER = """SELECT concat('https://shop.example.com/', o_custkey) AS url,
  CASE o_orderstatus WHEN 'F' THEN 'completed' ELSE 'failed' END AS status FROM {orders}"""
_LEDGER_SQL = "ledger AS (" + _LEDGER.format(orders="orders").replace("concat('https://shop.example.com/', o_custkey)", "'https://shop.example.com/' || o_custkey") + ")"


def _ledger(spark, sf_dir):
    return spark.sql(_LEDGER.format(orders="{o}"), o=table(spark, sf_dir, "orders"))


def _urls(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr("c_custkey AS ord", "concat('https://shop.example.com/', c_custkey) AS url")


_URLS_SQL = "urls AS (SELECT c_custkey AS ord, 'https://shop.example.com/' || c_custkey AS url FROM customer)"


@query(f"WITH {_LEDGER_SQL}, {_URLS_SQL} SELECT * FROM urls WHERE url NOT IN (SELECT url FROM ledger WHERE status = 'completed')")
def frontier(spark, sf_dir):
    return joins.frontier(_urls(spark, sf_dir), _ledger(spark, sf_dir), "url")


@query(f"WITH {_LEDGER_SQL}, {_URLS_SQL} SELECT * FROM urls WHERE url NOT IN (SELECT url FROM ledger WHERE length(url) % 2 = 0)")
def frontier_no_retry(spark, sf_dir):
    return joins.frontier(_urls(spark, sf_dir), _ledger(spark, sf_dir).filter("length(url) % 2 = 0"), "url", retry_failed=False)


@query(f"WITH {_LEDGER_SQL}, {_URLS_SQL} SELECT * FROM urls WHERE url NOT IN (SELECT url FROM ledger WHERE status = 'completed')")
def frontier_from_snapshot(spark, sf_dir):
    """The frontier against a ledger of six runs, of which a snapshot covers four, one of them written twice."""
    path = shared_path(spark, "snapshots")
    marks = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "concat('https://shop.example.com/', o_custkey) AS url", "CASE o_orderstatus WHEN 'F' THEN 'completed' ELSE 'failed' END AS status")
    for run in (0, 1, 1, 2, 3, 4, 5):
        if run == 4:
            ledgers.compact(spark, path, buckets=8)
        writers.append_ledger(marks.filter(F.col("o_orderkey") % 6 == run), path, "url", "status", str(run))
    return ledgers.frontier(spark, path, _urls(spark, sf_dir))


@query(f"WITH {_LEDGER_SQL} SELECT url, bool_or(status = 'completed') AS done, count(*) AS attempts FROM ledger GROUP BY url")
def ledger_snapshot(spark, sf_dir):
    """What is known of each URL after three compactions and some marks since."""
    path = shared_path(spark, "snapshots")
    marks = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "concat('https://shop.example.com/', o_custkey) AS url", "CASE o_orderstatus WHEN 'F' THEN 'completed' ELSE 'failed' END AS status")
    for run in range(4):
        writers.append_ledger(marks.filter(F.col("o_orderkey") % 4 == run), path, "url", "status", str(run))
        if run < 3:
            ledgers.compact(spark, path, buckets=8)
    return ledgers.latest(spark, path).select("url", "done", "attempts")


@query(f"WITH {_LEDGER_SQL} SELECT status, count(*) AS n FROM ledger GROUP BY status")
def ledger_stats(spark, sf_dir):
    return aggregates.ledger_stats(_ledger(spark, sf_dir))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position, (row_number() OVER (ORDER BY o_orderkey) - 1) // 20 AS batch_id FROM orders")
def batch_ids(spark, sf_dir):
    return ordinals.batch_ids(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 20)


@query("""WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, position, CASE WHEN n // 8 = 0 THEN 7 ELSE least(position // (n // 8), 7) END AS shard_id FROM p""")
def shards(spark, sf_dir):
    return ordinals.shards(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 8)


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5 OFFSET 900")
def row_slice(spark, sf_dir):
    return ordinals.row_slice(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 900, 905)


@query("SELECT url FROM pages WHERE url <> '' ORDER BY page_id LIMIT 100")
def first_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return readers.first_values(pages, readers.find_url_column(pages.columns), "page_id", 100)


@query("SELECT DISTINCT url FROM pages WHERE url IS NOT NULL")
def distinct_urls(spark, sf_dir):
    return readers.distinct_urls(table(spark, sf_dir, "pages"))


@query("""WITH g AS (
  SELECT 0 AS generation, event_id, 'u' || user_id || '/' || json_extract_string(props, '$.k') AS page_url, value, NULL AS note FROM events WHERE event_type = 'view'
  UNION ALL SELECT 1, event_id, 'u' || user_id || '/' || json_extract_string(props, '$.k'), value, event_type FROM events WHERE event_type = 'click'
  UNION ALL SELECT 2, event_id, 'u' || user_id || '/' || json_extract_string(props, '$.k'), NULL, event_type FROM events)
SELECT page_url, generation, event_id, value, note FROM g
QUALIFY row_number() OVER (PARTITION BY page_url ORDER BY generation, event_id) = 1""")
def merge_generations(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn(
        "page_url", F.expr("concat('u', user_id, '/', get_json_object(props, '$.k'))")
    )
    views = e.filter("event_type = 'view'").select("page_url", "event_id", "value")
    clicks = e.filter("event_type = 'click'").selectExpr("page_url", "event_id", "value", "event_type AS note")
    final = e.selectExpr("page_url", "event_id", "event_type AS note")
    return dedup.merge_generations([views, clicks, final], "page_url", "event_id")


@query("""WITH g AS (
  SELECT 0 AS generation, event_id, 'u' || user_id || '/' || json_extract_string(props, '$.k') AS page_url, value, NULL AS note FROM events WHERE event_type = 'view'
  UNION ALL SELECT 1, event_id, 'u' || user_id || '/' || json_extract_string(props, '$.k'), value, event_type FROM events WHERE event_type = 'click'
  UNION ALL SELECT 2, event_id, 'u' || user_id || '/' || json_extract_string(props, '$.k'), NULL, event_type FROM events)
SELECT page_url, generation, event_id, value, note FROM g
QUALIFY row_number() OVER (PARTITION BY page_url ORDER BY generation, event_id) = 1""")
def merge_generations_by_key(spark, sf_dir):
    """The same result built set by set, the second one added twice: a set touches its own keys only."""
    e = table(spark, sf_dir, "events").withColumn("page_url", F.expr("concat('u', user_id, '/', get_json_object(props, '$.k'))"))
    views = e.filter("event_type = 'view'").select("page_url", "event_id", "value")
    clicks = e.filter("event_type = 'click'").selectExpr("page_url", "event_id", "value", "event_type AS note")
    final = e.selectExpr("page_url", "event_id", "event_type AS note")
    kept = shared_path(spark, "kept")
    for name, rows in (("views", views), ("clicks", clicks), ("clicks", clicks), ("final", final)):
        dedup.add_generation(rows, kept, "page_url", "event_id", name, buckets=16)
    return dedup.read_kept(spark, kept)


@query("""SELECT c_custkey, coalesce(n_name, 'TIMEOUT') AS n_name, coalesce(n_regionkey::VARCHAR, 'ERROR') AS region
FROM customer LEFT JOIN (SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey""")
def attach_results(spark, sf_dir):
    requests = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    results = table(spark, sf_dir, "nation").filter("n_regionkey <> 2").selectExpr(
        "n_nationkey AS c_nationkey", "n_name", "cast(n_regionkey AS string) AS region"
    )
    joined = joins.attach_results(requests, results, "c_nationkey", {"n_name": "TIMEOUT", "region": "ERROR"}, ["c_custkey"])
    return joined.drop("c_nationkey")


# --- pages -----------------------------------------------------------------------------------

_DECODE = "regexp_extract(html, '(?is)<{tag}[^>]*>(.*?)</{tag}>', 1)"


def _text_sql(tag: str) -> str:
    expr = f"regexp_replace({_DECODE.format(tag=tag)}, '<[^>]*>', '', 'g')"
    for entity, char in lx.HTML_ENTITIES:  # parsers also accept them without the semicolon
        expr = f"regexp_replace({expr}, '{entity}?', '{char.replace(chr(39), chr(39) * 2)}', 'g')"
    return f"trim(regexp_replace({expr}, '\\s+', ' ', 'g'))"


_VISIBLE_SQL = r"lower(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>', ' ', 'g'))"
_CAPTCHA_SQL = f"WHEN contains({_VISIBLE_SQL}, 'captcha') OR contains({_VISIBLE_SQL}, 'robot') THEN 'captcha'"


def _status_sql(captcha: str) -> str:
    return f"""CASE WHEN contains(url, 'accounts.google.com') OR contains(url, 'signin') THEN 'login' {captcha}
  WHEN contains({_text_sql('title')}, '{lx.BLOCK_TITLE}') THEN 'blocked'
  WHEN {_text_sql('h1')} = '{lx.DEAD_HEADING}' THEN 'dead' ELSE 'ok' END"""


@query("SELECT page_id, nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title FROM pages")
def page_titles(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.html_title(F.col("html")).alias("title"))


@query(f"""SELECT page_id, url, {_text_sql('title')} AS page_title, {_text_sql('h1')} AS product_name,
  NULL::VARCHAR AS visit_website_url, NULL::VARCHAR AS additional_url, {_status_sql('')} AS page_status FROM pages""")
def page_fields(spark, sf_dir):
    return crawl.product_rows(spread_table(spark, sf_dir, "pages", "page_id", "url", "html"))


# Product pages rendered from parts; size decides which markup the page has, or that it is dead.
_PRODUCT_HTML = f"""concat('<html><head><meta name="robots" content="index"><title>', p_name, ' | ', p_brand, '</title></head><body>',
  CASE WHEN p_size > 45 THEN '<h1>{lx.DEAD_HEADING}</h1>'
    WHEN p_size > 30 THEN concat('<h1> </h1><p class="product-name">', p_name, '</p>')
    ELSE concat('<h1 class="color-darker-grey"><b>', p_name, '</b>\n  &amp; ', p_type, '</h1>') END,
  CASE WHEN p_size > 40 THEN '' WHEN p_size > 20 THEN concat('<a href="https://x.example.com/', p_partkey, '?ref=producthunt">go</a>')
    WHEN p_size > 10 THEN concat('<a href="../go/', p_partkey, '"> visit  WEBSITE </a>')
    ELSE concat('<div data-test="visit-website-button" href="/go/', p_partkey, '">v</div>') END,
  CASE WHEN p_size > 25 THEN '<span class="max-w-[260px] truncate font-semibold">none</span>'
    ELSE concat('<span class="font-semibold truncate">x.example.com/', p_partkey, '</span>') END,
  CASE WHEN p_type = 'SMALL' AND p_size < 5 THEN '<p>Are you a Robot?</p>' ELSE '' END, '</body></html>')"""


def _product_pages(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return parts.selectExpr("p_partkey", "concat('https://hunt.example.com/p/', p_partkey, '/') AS url", _PRODUCT_HTML + " AS html")


@query(f"""SELECT p_partkey, 'https://hunt.example.com/p/' || p_partkey || '/' AS url, p_name || ' | ' || p_brand AS page_title,
  CASE WHEN p_size > 45 THEN '{lx.DEAD_HEADING}' WHEN p_size > 30 THEN p_name ELSE p_name || ' & ' || p_type END AS product_name,
  CASE WHEN p_size > 40 THEN NULL WHEN p_size > 20 THEN 'https://x.example.com/' || p_partkey || '?ref=producthunt'
    WHEN p_size > 10 THEN 'https://hunt.example.com/p/go/' || p_partkey
    ELSE 'https://hunt.example.com/go/' || p_partkey END AS visit_website_url,
  CASE WHEN p_size <= 25 THEN 'x.example.com/' || p_partkey END AS additional_url,
  CASE WHEN p_size > 45 THEN 'dead' ELSE 'ok' END AS page_status FROM part""")
def product_rows(spark, sf_dir):
    return crawl.product_rows(_product_pages(spark, sf_dir))


@query(f"""WITH r AS (SELECT p_size / 10.0::DOUBLE AS s, CASE WHEN p_size > 45 THEN 'dead' ELSE 'ok' END AS st FROM part)
SELECT count(*) AS total, count(*) AS raw_success, count(*) FILTER (st = 'ok') AS live_success,
  {sql_rate('count(*)', 'count(*)', '100.0')} AS raw_success_pct,
  {sql_rate("count(*) FILTER (st = 'ok')", 'count(*)', '100.0')} AS live_success_pct,
  {sql_rate('sum(s)', 'count(*)')} AS seconds_per_url, {sql_rate('count(*)', 'sum(s)', '3600.0')} AS urls_per_hour FROM r""")
def run_report(spark, sf_dir):
    """Success counts over the extracted product pages, with the size as time spent."""
    pages = _product_pages(spark, sf_dir).join(
        table(spark, sf_dir, "part").selectExpr("p_partkey", "p_size / 10D AS scrape_time"), "p_partkey"
    )
    return aggregates.run_report(crawl.product_rows(pages), "product_name", "page_status", "scrape_time")


@query(f"""WITH p AS (SELECT *, 'https://hunt.example.com/p/' || p_partkey || '/' AS url FROM part),
u AS (SELECT DISTINCT 'https://hunt.example.com/p/' || (l_partkey + l_linenumber) || '/' AS url FROM lineitem),
d AS (SELECT DISTINCT 'https://hunt.example.com/p/' || l_partkey || '/' AS url FROM lineitem WHERE l_quantity > 45 AND l_discount < 0.05)
SELECT u.url, CASE WHEN p.p_size > 45 THEN '{lx.DEAD_HEADING}' WHEN p.p_size > 30 THEN p.p_name ELSE p.p_name || ' & ' || p.p_type END AS product_name,
  CASE WHEN p.p_partkey IS NULL THEN 'missing' WHEN p.p_size > 45 THEN 'dead' ELSE 'ok' END AS page_status,
  CASE WHEN p.p_partkey IS NULL THEN 'failed' WHEN p.p_size > 45 THEN 'dead' ELSE 'completed' END AS status
FROM u LEFT JOIN p USING (url) WHERE u.url NOT IN (SELECT url FROM d)""")
def crawl_run(spark, sf_dir):
    """End to end: requested URLs minus the done ones, product rows, and a status for each."""
    lines = table(spark, sf_dir, "lineitem")
    wanted = lines.selectExpr("concat('https://hunt.example.com/p/', l_partkey + l_linenumber, '/') AS url")
    ledger = lines.filter("l_quantity > 45 AND l_discount < 0.05").selectExpr(
        "concat('https://hunt.example.com/p/', l_partkey, '/') AS url", "'completed' AS status"
    )
    rows = crawl.crawl_run(wanted, ledger, _product_pages(spark, sf_dir).drop("p_partkey"))
    return rows.select("url", "product_name", "page_status", "status")


@query(f"""SELECT url, CASE WHEN c_mktsegment = 'FURNITURE' THEN '{lx.BLOCK_TITLE}' ELSE c_name END AS page_title,
  CASE c_mktsegment WHEN 'FURNITURE' THEN 'BLOCKED' WHEN 'MACHINERY' THEN 'N/A' ELSE c_name END AS tool_name
FROM (SELECT *, 'https://hunt.example.com/' || c_custkey AS url FROM customer)""")
def tool_name_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "customer").selectExpr(
        "concat('https://hunt.example.com/', c_custkey) AS url",
        f"""concat('<TITLE>', CASE WHEN c_mktsegment = 'FURNITURE' THEN '{lx.BLOCK_TITLE}' ELSE c_name END, '</TITLE>',
          CASE c_mktsegment WHEN 'MACHINERY' THEN '<h1>x</h1>'
            WHEN 'HOUSEHOLD' THEN concat('<h1 class="gray text-16 font-normal text-dark-gray text-24 font-semibold text-gray-900">', c_name, '</h1>')
            ELSE concat('<h1 data-sentry-component="LegacyText">', c_name, '</h1>') END) AS html""",
    )
    return crawl.tool_names(pages)


@query(f"SELECT page_id, {_status_sql(_CAPTCHA_SQL)} AS page_status FROM pages")
def page_status(spark, sf_dir):
    """Status from native expressions alone."""
    html = F.col("html")
    heading = F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    status = predicates.page_status(F.col("url"), text.html_title(html), heading, html)
    return table(spark, sf_dir, "pages").select("page_id", status.alias("page_status"))


@query(r"""WITH c AS (SELECT page_id, url, regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', '', 'g') AS h FROM pages),
l AS (SELECT page_id, url, unnest(regexp_extract_all(h, '(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1)) AS href,
  unnest(regexp_extract_all(h, '(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 2)) AS link_text FROM c)
SELECT page_id, href, link_text, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^(https?://[^/?#]*)', 1) || href ELSE href END AS absolute FROM l""")
def page_links(spark, sf_dir):
    rows = spread_table(spark, sf_dir, "pages", "page_id", "url", "html").select(
        "page_id", "url", F.explode(extract.links_column(F.col("html"))).alias("l")
    )
    return rows.select(
        "page_id", "l.href", F.col("l.text").alias("link_text"),
        urls.absolute_url(F.col("url"), F.col("l.href")).alias("absolute"),
    )


_NAV = extract.RecordSpec(
    containers=(extract.El("a", inside=extract.El("nav")),),
    fields=(extract.Take("href", (), "href"), extract.Take("link_text", ())),
)


@query(r"""WITH c AS (SELECT page_id, regexp_extract(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?s)<nav>(.*?)</nav>', 1) AS h FROM pages)
SELECT page_id, unnest(regexp_extract_all(h, '(?s)<a href="([^"]*)">(.*?)</a>', 1)) AS href,
  unnest(regexp_extract_all(h, '(?s)<a href="([^"]*)">(.*?)</a>', 2)) AS link_text FROM c""")
def nav_records(spark, sf_dir):
    """The same links through the tree parser, which skips scripts and comments by itself."""
    rows = extract.extract_records(spread_table(spark, sf_dir, "pages", "page_id", "html"), _NAV)
    return rows.select("page_id", "href", "link_text")


@query(f"""SELECT ord AS event_id, contains(href, '.') AND contains(href, '/') AS looks_like_url, CASE WHEN href = '' THEN base WHEN href LIKE 'https:%' THEN href WHEN href LIKE '//%' THEN 'https:' || href
  WHEN href LIKE '/%' THEN 'https://h.example.com' || href WHEN href LIKE '?%' THEN 'https://h.example.com/a/b' || href
  WHEN href LIKE '#%' THEN 'https://h.example.com/a/b?x=1' || href
  WHEN href LIKE '../%' THEN 'https://h.example.com/' || href[4:] ELSE 'https://h.example.com/a/' || href END AS absolute
FROM (SELECT event_id AS ord, 'https://h.example.com/a/b?x=1#f' AS base, CASE event_type WHEN 'view' THEN '/p/' || user_id WHEN 'click' THEN '../p' || user_id
  WHEN 'error' THEN CASE WHEN value > 10 THEN '' ELSE 'https://o.example.com/' || user_id END
  WHEN 'signup' THEN CASE WHEN value > 10 THEN '?u=' || user_id ELSE '#u' || user_id END
  ELSE CASE WHEN value > 10 THEN '//cdn.example.com/' || user_id ELSE 'p' || user_id || '?q=/../x' END END AS href FROM events)""")
def absolute_links(spark, sf_dir):
    href = F.expr("""CASE event_type WHEN 'view' THEN concat('/p/', user_id) WHEN 'click' THEN concat('../p', user_id)
      WHEN 'error' THEN CASE WHEN value > 10 THEN '' ELSE concat('https://o.example.com/', user_id) END
      WHEN 'signup' THEN CASE WHEN value > 10 THEN concat('?u=', user_id) ELSE concat('#u', user_id) END
      ELSE CASE WHEN value > 10 THEN concat('//cdn.example.com/', user_id) ELSE concat('p', user_id, '?q=/../x') END END""")
    base = F.lit("https://h.example.com/a/b?x=1#f")
    return table(spark, sf_dir, "events").select(
        "event_id", urls.looks_like_url(href).alias("looks_like_url"), urls.absolute_url(base, href).alias("absolute")
    )


# --- reviews ---------------------------------------------------------------------------------

# One page per order line with two reviews; returned lines have none.
_REVIEW_HTML = """concat('<h1 class="color-darker-grey">Tool ', l_partkey, '</h1>',
  CASE WHEN l_linestatus = 'O' THEN concat('<a class="styles_format__k3_8m" href="https://t.example.com/', l_partkey, '">site</a>') ELSE '' END,
  '<div class="styles_reviewPositive__JY_9N">4.5/5 All time (', l_suppkey, ' reviews)</div>',
  '<div class="flex direction-row"><b></b><span class="color-lighter-grey fontSize-14 fontWeight-400">Recently (', l_linenumber, ' reviews)</span></div>',
  CASE WHEN l_returnflag = 'R' THEN '' ELSE concat(
    '<div class="c" id="review-', l_orderkey, '"><a class="color-darker-grey fontSize-16 fontWeight-600" href="/@u', l_suppkey, '">User ', l_suppkey, '</a>',
    '<div class="styles_htmlText__iftLe">Good  <i>tool</i>\n', l_partkey, '</div><time datetime="', date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss'), '">x</time>',
    '<div class="color-lighter-grey fontSize-12 fontWeight-600">Helpful (', l_linenumber, ')</div></div><div id="review-b', l_orderkey, '"></div>') END) AS html"""


@query("""WITH l AS (SELECT *, 'https://hunt.example.com/' || l_orderkey || '/' || l_linenumber AS product_url FROM lineitem WHERE l_returnflag <> 'R'),
p AS (SELECT *, 'Tool ' || l_partkey AS tool_name, '4.5/5 All time (' || l_suppkey || ' reviews)' AS all_time_score,
  l_suppkey::VARCHAR AS amount_of_reviews, CASE WHEN l_linestatus = 'O' THEN 'https://t.example.com/' || l_partkey ELSE 'N/A' END AS tool_link,
  'N/A' AS recent_review_score, l_linenumber::VARCHAR AS recent_reviews_amount FROM l)
SELECT tool_name, 'review-' || l_orderkey AS review_id, 'Good tool ' || l_partkey AS review_text,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS review_date, 'User ' || l_suppkey AS user_name, '/@u' || l_suppkey AS user_href,
  l_linenumber::VARCHAR AS helpful_count, all_time_score, amount_of_reviews, tool_link, recent_review_score, recent_reviews_amount, product_url FROM p
UNION ALL SELECT tool_name, 'review-b' || l_orderkey, 'N/A', 'N/A', 'N/A', 'N/A', '0', all_time_score, amount_of_reviews, tool_link, recent_review_score, recent_reviews_amount, product_url FROM p""")
def review_rows(spark, sf_dir):
    lines = spread_table(
        spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_linestatus", "l_returnflag", "l_shipdate",
    )
    pages = lines.selectExpr(
        "concat('https://hunt.example.com/', l_orderkey, '/', l_linenumber) AS url", _REVIEW_HTML
    )
    return crawl.review_rows(pages)


@query("""SELECT event_id, CASE WHEN event_type = 'view' THEN user_id::VARCHAR ELSE 'N/A' END AS all_time,
  CASE WHEN event_type = 'click' THEN user_id::VARCHAR ELSE 'N/A' END AS recent,
  CASE WHEN event_type = 'error' THEN user_id::VARCHAR ELSE '0' END AS helpful,
  CASE WHEN event_type <> 'signup' THEN date_trunc('second', ts) END AS review_time FROM events""")
def review_numbers(spark, sf_dir):
    line = F.expr("""concat('x ', CASE event_type WHEN 'view' THEN 'All time' WHEN 'click' THEN 'Recently'
      WHEN 'error' THEN 'Helpful' ELSE 'Seen' END, ' (', user_id, CASE WHEN event_type = 'error' THEN ')' ELSE ' reviews)' END, ' (9 reviews)')""")
    stamp = F.when(F.col("event_type") == "signup", "N/A").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, sf_dir, "events").select(
        "event_id", text.total_review_count(line).alias("all_time"), text.recent_review_count(line).alias("recent"),
        text.helpful_count(line).alias("helpful"), text.review_time(stamp).cast("timestamp_ntz").alias("review_time"),
    )


@query("""SELECT event_id, user_id AS item, event_type AS kind FROM events WHERE event_type <> 'error'
UNION ALL SELECT event_id, json_extract_string(props, '$.k')::BIGINT, 'k' FROM events WHERE event_type <> 'error'""")
def response_rows(spark, sf_dir):
    """Responses with a `data` array, flattened; failed responses carry none."""
    body = F.expr("""CASE WHEN event_type = 'error' THEN '{"detail": "rate limit"}' ELSE concat(
      '{"status": "ok", "data": [{"item": ', user_id, ', "kind": "', event_type, '"}, {"item": ',
      get_json_object(props, '$.k'), ', "kind": "k"}]}') END""")
    rows = table(spark, sf_dir, "events").select("event_id", body.alias("body"))
    return readers.unwrap_data(rows, "body", "item: BIGINT, kind: STRING")


@query(f"""WITH {v.ARTICLES_SQL} SELECT doc_id, title FROM articles WHERE lang <> 'de'""")
def fetched_records(spark, sf_dir):
    """Successful fetches flattened to their records."""
    fetches = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("lang") == "de", "error").otherwise("success").alias("status"),
        F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("title"))).alias("records"),
    )
    return extract.flatten_success(fetches, "status", "records")


# --- files -----------------------------------------------------------------------------------


@query("""SELECT c_custkey AS tool_id, c_name AS tool_name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment || ', "q"' END AS tool_url FROM customer""")
def csv_round_trip(spark, sf_dir):
    """Missing text is written as the sentinel and read back as null."""
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS tool_id", "c_name AS tool_name", "c_acctbal AS extra",
        """CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE concat(c_mktsegment, ', "q"') END AS tool_url""",
    )
    path = shared_path(spark, "csv")
    writers.write_csv(writers.with_sentinels(rows, {"tool_url": lx.NOT_AVAILABLE}), path, ["tool_id", "tool_name", "tool_url"])
    return readers.read_csv(spark, path, schemas.TOOL_SEED)


@query("SELECT status, count(*) AS n, count(DISTINCT url) AS urls FROM (SELECT 'p' || page_id AS url, 'completed' AS status FROM pages UNION ALL SELECT url, 'failed' FROM pages) GROUP BY status")
def ledger_round_trip(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    path = shared_path(spark, "ledger")
    done = pages.select(F.concat(F.lit("p"), F.col("page_id")).alias("url"), F.lit("completed").alias("status"))
    writers.append_ledger(done, path, "url", "status", "1")
    writers.append_ledger(pages.withColumn("status", F.lit("failed")), path, "url", "status", "2")
    return readers.read_ledger(spark, path).groupBy("status").agg(
        F.count("*").alias("n"), F.count_distinct("url").alias("urls")
    )


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL")
def run_partitions(spark, sf_dir):
    """Two stamped runs appended to one table, read back whole."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    path = shared_path(spark, "runs")
    writers.write_run(events.filter("event_type = 'view'"), path, "2024-01-01 00:00:00")
    writers.write_run(events.filter("event_type <> 'view'"), path, "2024-01-02 04:00:00")
    return spark.read.parquet(path).filter("run_date <= '2024-01-02'").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query(f"""SELECT 'Started ' || strftime(ts, '%Y%m%d_%H%M%S') AS stamp, ts + INTERVAL 4 HOUR AS next_run,
  round(value * 3.6, 5)::DOUBLE AS seconds, event_id FROM events""")
def run_times(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    later = F.timestamp_micros(F.unix_micros(ts) + F.round(F.col("value") * 3600000).cast("long"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("Started "), text.run_stamp(ts)).alias("stamp"),
        text.next_run(ts, 4).cast("timestamp_ntz").alias("next_run"),
        F.round(text.seconds_between(F.timestamp_micros(F.unix_micros(ts)), later), 5).cast("double").alias("seconds"),
    )


@query("""SELECT 'u' || user_id || '/' || json_extract_string(props, '$.k') AS page_url, min(event_id) AS event_id,
  arg_min(event_type, event_id) AS product_name FROM events GROUP BY 1""")
def generations_from_files(spark, sf_dir):
    """Result files of several runs, read by name pattern, stacked, first row per URL kept."""
    root = shared_path(spark, "backups")
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "concat('u', user_id, '/', get_json_object(props, '$.k')) AS page_url", "event_type AS product_name"
    )
    writers.append_rows(events, f"{root}/all")
    events = readers.read_rows(spark, f"{root}/all", "event_id BIGINT, page_url STRING, product_name STRING")
    for kind in ("view", "click"):
        part = events.filter(F.col("product_name") == kind)
        writers.write_csv(part, f"{root}/backup_{kind}", ["event_id", "page_url", "product_name"])
    backups = readers.read_generations(
        spark, f"{root}/backup_*", "event_id BIGINT, page_url STRING, product_name STRING"
    ).drop("file_path")
    rest = events.filter(~F.col("product_name").isin("view", "click"))
    return dedup.keep_first(dedup.union_all(backups, rest), ["page_url"], ["event_id"])


@query("""SELECT c_custkey AS tool_id, c_name AS tool_name, c_mktsegment AS tool_url FROM customer""")
def csv_reordered_columns(spark, sf_dir):
    """Two files with the columns in another order, one of them with one more."""
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey AS tool_id", "c_name AS tool_name", "c_mktsegment AS tool_url", "c_acctbal AS extra")
    root = shared_path(spark, "reordered")
    writers.write_csv(rows.filter("tool_id % 2 = 0"), f"{root}/a", ["tool_url", "tool_id", "tool_name"])
    writers.write_csv(rows.filter("tool_id % 2 = 1"), f"{root}/b", ["tool_name", "extra", "tool_url", "tool_id"])
    return readers.read_csv(spark, [f"{root}/a", f"{root}/b"], schemas.TOOL_SEED)


@query("""SELECT event_id, 'u' || user_id AS page_url, CASE WHEN event_type <> 'view' THEN event_type END AS product_name
FROM events WHERE event_type IN ('view', 'click')""")
def generations_mixed_layouts(spark, sf_dir):
    """Result files of which one lacks a column, one has others, and one is no result file at all."""
    root = shared_path(spark, "mixed")
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "concat('u', user_id) AS page_url", "event_type AS product_name", "value", "ts")
    writers.write_csv(rows.filter("product_name = 'view'"), f"{root}/backup_view", ["page_url", "value", "event_id"])
    writers.write_csv(rows.filter("product_name = 'click'"), f"{root}/backup_click", ["product_name", "event_id", "page_url"])
    writers.write_csv(rows, f"{root}/backup_other", ["value", "ts"])
    return readers.read_generations(spark, f"{root}/backup_*", "event_id BIGINT, page_url STRING, product_name STRING").drop("file_path")


@query("""SELECT o_orderkey AS tool_id, o_orderpriority AS tool_name, o_clerk AS tool_url FROM (SELECT o_orderkey, o_orderstatus AS o_orderpriority,
  CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE 'x"' || chr(44) || o_custkey END AS o_clerk FROM orders)""")
def csv_headers_once(spark, sf_dir):
    """Many files with three different headers: their first lines tell which columns to read, and rows are read once."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS tool_id", "o_orderstatus AS tool_name", "CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE concat('x\",', o_custkey) END AS tool_url", "o_totalprice AS extra")
    root = shared_path(spark, "layouts")
    for i, names in enumerate((["tool_id", "tool_name", "tool_url"], ["tool_url", "extra", "tool_name", "tool_id"], ["extra", "tool_id", "tool_url", "tool_name"])):
        writers.write_csv(rows.filter(F.col("tool_id") % 3 == i), f"{root}/part_{i}", names)
    return readers.read_csv(spark, f"{root}/part_*", schemas.TOOL_SEED)


@query("""SELECT 'read' AS what, count(*) AS n, sum(o_orderkey)::BIGINT AS ids FROM orders UNION ALL SELECT 'damaged', 1, NULL UNION ALL SELECT 'not UTF-8', 1, NULL
UNION ALL SELECT 'no known column', 1, NULL""")
def broken_files(spark, sf_dir):
    """Result files of which one is a truncated archive, one holds a byte that is no text, and one is of another kind."""
    root = shared_path(spark, "broken")
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS event_id", "concat('u', o_custkey) AS page_url")
    writers.write_csv(orders, f"{root}/backup_good", ["event_id", "page_url"])
    packed = gzip.compress(b"event_id,page_url\n" + b"".join(b"%d,u\n" % i for i in range(500)))[:-40]
    one = orders.limit(1)
    for name, content in (("cut", packed), ("byte", b"event_id,page_url\n1,\xff\xfe"), ("other", b"a,b\n1,2")):
        one.select(F.lit(content).cast("string").alias("value")).coalesce(1).write.text(f"{root}/backup_{name}")
    rows = files.read_whole(spark, f"{root}/backup_*", "event_id BIGINT, page_url STRING")
    what = F.coalesce(F.regexp_extract("reason", "^(damaged|not UTF-8|no known column)", 1), F.lit("read"))
    return rows.groupBy(what.alias("what")).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("SELECT event_type AS status, count(*) AS n, 'once' AS counted FROM events GROUP BY event_type")
def append_twice(spark, sf_dir):
    """Batches of which one ends before it is listed, one is written twice and one is repeated by a later run: each row counts once."""
    path = shared_path(spark, "appended")
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "event_type AS status")
    for i in (0, 1, 2):
        part = rows.filter(F.col("event_id") % 3 == i)
        if i == 1:
            batches.write_attempt(part, path)  # ended here
        writers.append_rows(part, path, f"run-{i}")
    writers.append_rows(rows.filter("event_id % 3 = 2"), path, "run-2")
    once = readers.read_rows(spark, path, "event_id BIGINT, status STRING").groupBy("event_id", "status").agg(F.count("*").alias("c"))
    return once.groupBy("status").agg(F.sum("c").alias("n"), F.when(F.max("c") == 1, "once").otherwise("more").alias("counted"))


# --- runs ------------------------------------------------------------------------------------


@query("""WITH r AS (SELECT user_id::VARCHAR AS job, ts AS started, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'started' ELSE 'completed' END AS state, event_id,
    ts + INTERVAL 10 MINUTE AS ended FROM events),
n AS (SELECT max(ts) + INTERVAL 1 MINUTE AS now FROM events),
l AS (SELECT job, started, CASE WHEN state = 'started' AND started + INTERVAL 2 HOUR <= now THEN 'failed' ELSE state END AS state,
    CASE WHEN state = 'started' AND started + INTERVAL 2 HOUR <= now THEN started + INTERVAL 2 HOUR WHEN state = 'started' THEN started ELSE ended END AS ended, now FROM r, n),
d AS (SELECT job, max(ended) FILTER (state = 'completed') AS done, max({'s': started, 'e': ended, 'x': state}) AS last, any_value(now) AS now FROM l GROUP BY job),
f AS (SELECT d.*, (SELECT count(*) FROM l WHERE l.job = d.job AND l.state = 'failed' AND (done IS NULL OR l.ended > done)) AS failures FROM d),
t AS (SELECT job, last.x AS state, failures, now, CASE last.x WHEN 'completed' THEN last.s + INTERVAL 4 HOUR WHEN 'started' THEN last.s + INTERVAL 2 HOUR
    ELSE last.e + least(16, power(2, greatest(failures - 1, 0)))::INTEGER * INTERVAL 1 HOUR END AS due FROM f)
SELECT job, state, failures, due, state <> 'started' AND due <= now AS is_due FROM t""")
def run_schedule(spark, sf_dir):
    """When each job may run next, after its last run completed, failed, or was not heard of; each event plays a run."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("job"), F.col("ts").cast("timestamp").alias("started"), "event_type")
    state = F.expr("CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'started' ELSE 'completed' END")
    ended = F.when(state == "started", F.col("started")).otherwise(F.timestamp_micros(F.unix_micros("started") + 600_000_000))
    rows = e.select("job", F.col("event_id").cast("string").alias("run_id"), state.alias("state"), "started", ended.alias("at"), F.lit(None).cast("string").alias("error"))
    now = e.agg(F.timestamp_micros(F.unix_micros(F.max("started")) + 60_000_000).alias("now")).first()["now"]
    told = runs.schedule(rows, F.lit(now), runs.Policy(lease=timedelta(hours=2)))
    return told.withColumn("due", F.col("due").cast("timestamp_ntz"))


# --- streams ---------------------------------------------------------------------------------


def _event_files(spark, sf_dir):
    """The events written as several files, as a crawl would leave them."""
    path = shared_path(spark, "requests")
    events = table(spark, sf_dir, "events").selectExpr("event_id", "ts", "concat('u', user_id) AS url", "event_type AS status")
    events.repartition(4, "event_id").write.parquet(path)
    return path, events.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")


@query("SELECT event_type AS status, count(*) AS n FROM events GROUP BY event_type")
def stream_status_counts(spark, sf_dir):
    path, schema = _event_files(spark, sf_dir)
    stream = streams.stream_files(spark, path, schema, files_per_batch=2)
    sink, checkpoint = shared_path(spark, "counts"), shared_path(spark, "counts-checkpoint")
    streams.status_counts(stream, "status", sink, checkpoint).awaitTermination()
    return streams.read_counts(spark, sink)


@query("SELECT event_type AS status, count(*) AS n FROM events GROUP BY event_type")
def stream_status_updates(spark, sf_dir):
    """The same counters in update mode: each batch writes those that it changed."""
    path, schema = _event_files(spark, sf_dir)
    stream = streams.stream_files(spark, path, schema, files_per_batch=2)
    sink, checkpoint = shared_path(spark, "updates"), shared_path(spark, "updates-checkpoint")
    streams.status_counts(stream, "status", sink, checkpoint, mode="update").awaitTermination()
    return streams.read_counts(spark, sink)


@query("SELECT DISTINCT 'u' || user_id AS url FROM events")
def incremental_dedup(spark, sf_dir):
    """URLs seen before are dropped, also by a second run on the same checkpoint."""
    path, schema = _event_files(spark, sf_dir)
    out, checkpoint = shared_path(spark, "seen"), shared_path(spark, "seen-checkpoint")
    for _ in range(2):
        stream = streams.stream_files(spark, path, schema, files_per_batch=2).select("url")
        streams.append_snapshots(streams.first_seen(stream, "url"), out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select("url")


@query("""SELECT url, CASE WHEN length(url) > 3 THEN 'completed' ELSE 'failed' END AS status
FROM (SELECT DISTINCT 'u' || user_id AS url FROM events)""")
def incremental_crawl(spark, sf_dir):
    """Batches against the ledger: done URLs are fetched once, failed ones again; the last status counts."""
    path, schema = _event_files(spark, sf_dir)
    ledger, out = shared_path(spark, "crawl-ledger"), shared_path(spark, "crawl-out")

    def fetch(todo):
        status = F.when(F.length("url") > 3, "completed").otherwise("failed")
        return todo.select("url", status.alias("status"))

    stream = streams.stream_files(spark, path, schema, files_per_batch=1)
    streams.crawl_batches(
        stream, ledger, out, shared_path(spark, "crawl-checkpoint"), "url", "event_id", fetch
    ).awaitTermination()
    rows = readers.read_ledger(spark, ledger).withColumn("run", F.col("run_id").cast("bigint"))
    return rows.groupBy("url").agg(F.max_by("status", "run").alias("status"))


@query("""SELECT url, 'completed' AS status, CASE WHEN length(url) > 3 THEN 1 ELSE 3 END AS attempts
FROM (SELECT DISTINCT 'u' || user_id AS url FROM events)""")
def crawl_retry(spark, sf_dir):
    """One set of request files, three runs: URLs that failed are asked again without a new request."""
    path, schema = _event_files(spark, sf_dir)
    ledger, out, checkpoint = shared_path(spark, "retry-ledger"), shared_path(spark, "retry-out"), shared_path(spark, "retry-checkpoint")
    for attempt in (1, 2, 3):
        def fetch(todo, attempt=attempt):
            status = F.when((F.length("url") > 3) | F.lit(attempt == 3), "completed").otherwise("failed")
            return todo.select("url", status.alias("status"))

        stream = streams.stream_files(spark, path, schema, files_per_batch=10)
        streams.crawl_batches(stream, ledger, out, checkpoint, "url", "event_id", fetch).awaitTermination()
    return streams.latest_status(readers.read_ledger(spark, ledger))
