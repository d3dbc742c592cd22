"""Product crawl: fetched pages to product rows, reviews, merged results and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork import lexicons as lx
from gleanwork.functions import predicates, text, urls
from gleanwork.operators import dedup, extract, joins, page_specs, skew


def product_rows(pages: DataFrame, url: str = "url") -> DataFrame:
    """One product row per page, with its link made absolute and its page status."""
    kept = [c for c in pages.columns if c != "html"]
    record = extract.records_column(F.col("html"), page_specs.PRODUCT_PAGE)
    href = F.nullif(F.col("__r.visit_href"), F.lit(""))
    absolute = F.when(F.startswith(href, F.lit("http")), href).otherwise(urls.absolute_url(F.col(url), href))
    # Product pages have no challenge page of their own.
    status = predicates.page_status(
        F.col(url), F.col("__r.page_title"), F.col("__r.product_name"), F.col("html"), captcha_words=()
    )
    return pages.withColumn("__r", F.get(record, F.lit(0))).select(
        *kept,
        "__r.page_title",
        "__r.product_name",
        absolute.alias("visit_website_url"),
        "__r.additional_url",
        status.alias("page_status"),
    )


def crawl_run(
    urls: DataFrame, ledger: DataFrame, pages: DataFrame, key: str = "url", fetched: str | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """One run over the URLs not yet done: a product row and a ledger status for each.

    URLs without a page keep a row with nulls. Live pages are completed, dead ones final; blocked
    and missing ones stay in the frontier. Pages are joined once and parsed afterwards. With
    `fetched`, a time column, the latest page of a URL counts; otherwise pages are unique.
    """
    if fetched is not None:
        newest = pages.withColumn("__age", -F.unix_micros(F.col(fetched).cast("timestamp")))
        pages = dedup.keep_first(newest, [key], ["__age"]).drop("__age")
    todo = joins.frontier(urls.select(key).distinct(), ledger, key)
    found = skew.equi_join(todo, pages.withColumn("__got", F.lit(True)), [key], "left", "drop", spread_by)
    rows = product_rows(found, key)
    there = F.coalesce(F.col("__got"), F.lit(False))
    page = F.when(there, F.col("page_status")).otherwise("missing")
    status = F.when(page == "ok", "completed").when(page == "dead", "dead").otherwise("failed")
    return rows.withColumns({"page_status": page, "status": status}).drop("__got")


def tool_names(pages: DataFrame) -> DataFrame:
    """Title and tool name per page; blocked pages say so, pages without a name `N/A`."""
    rows = extract.extract_records(pages, page_specs.TOOL_NAME_PAGE).drop("pos")
    blocked = F.coalesce(F.contains(F.col("page_title"), F.lit(lx.BLOCK_TITLE)), F.lit(False))
    return rows.withColumn("tool_name", F.when(blocked, "BLOCKED").otherwise(F.col("tool_name")))


def review_rows(pages: DataFrame, url: str = "url") -> DataFrame:
    """One row per review with the page's own numbers; pages without reviews give none."""
    found = extract.extract_records(
        pages.select(F.col(url).alias("product_url"), "html"), page_specs.REVIEWS
    )
    return found.select(
        "tool_name", "review_id", "review_text", "review_date", "user_name", "user_href",
        text.helpful_count(F.col("helpful_text")).alias("helpful_count"),
        "all_time_score",
        text.total_review_count(F.col("all_time_score")).alias("amount_of_reviews"),
        "tool_link", "recent_review_score",
        text.recent_review_count(F.col("recent_reviews_text")).alias("recent_reviews_amount"),
        "product_url",
    )
