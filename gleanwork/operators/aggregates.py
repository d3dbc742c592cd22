"""Counts, frequency tables, duplicate analysis and run reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.tags import to_list
from gleanwork.functions.text import rate
from gleanwork.session import staged


def count_where(df: DataFrame, condition: Column, out: str = "n") -> DataFrame:
    return df.agg(F.count_if(condition).alias(out))


def frequency(df: DataFrame, column: str, out: str = "n") -> DataFrame:
    """Value counts without the missing value."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(out))


def top_k(df: DataFrame, column: str, k: int, out: str = "n") -> DataFrame:
    """Most frequent values; ties go to the lower value."""
    return frequency(df, column, out).orderBy(F.desc(out), F.asc(column)).limit(k)


def duplicate_overview(df: DataFrame, key: str) -> DataFrame:
    """Totals over a per-key count: rows, distinct keys, surplus, repeated keys, highest count."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    known = F.col(key).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(key).alias("distinct_keys"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count(key)).alias("surplus_rows"),
        F.count_if(known & (F.col("n") > 1)).alias("repeated_keys"),
        F.max(F.when(known & (F.col("n") > 1), F.col("n"))).alias("max_repeats"),
    )


def repeated_keys(df: DataFrame, key: str, k: int | None = None) -> DataFrame:
    """Keys occurring more than once; with `k` the most repeated ones."""
    found = frequency(df, key).filter("n > 1")
    return found if k is None else found.orderBy(F.desc("n"), F.asc(key)).limit(k)


#: Keys up to which a list of k keys is broadcast.
FEW_KEYS = 10_000


def repeated_rows(df: DataFrame, key: str, k: int) -> DataFrame:
    """All rows of the k most repeated keys, with the repeat count."""
    # A list of k rows; while it is short, the base is filtered in place instead of being shuffled by a hot key.
    keys = repeated_keys(df, key, k)
    return df.join(F.broadcast(keys) if k <= FEW_KEYS else keys, key)


def distinct_values_per_key(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Long form: one row per key, column and distinct value. Never one cell per key."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]))
    return (
        df.filter(F.col(key).isNotNull())
        .select(key, pairs.alias("p"))
        .select(key, "p.column", "p.value")
        .filter(F.col("value").isNotNull())
        .distinct()
    )


def explain_duplicates(
    df: DataFrame, key: str, name: str, columns: Sequence[str], order: str, k: int
) -> DataFrame:
    """For the k most repeated keys: first name and the number of different values per column."""
    # Two things are computed from these rows; staged, so that finding them is not done twice.
    rows = staged(repeated_rows(df.select(*{key: 0, name: 0, order: 0, **dict.fromkeys(columns, 0)}), key, k), "repeated")
    counts = distinct_values_per_key(rows, key, columns).groupBy(key).agg(
        *[F.count_if(F.col("column") == c).alias(f"distinct_{c}") for c in columns]
    )
    heads = rows.groupBy(key).agg(
        F.min_by(name, order).alias(name), F.count("*").alias("n")
    )
    return heads.join(counts, key, "left").na.fill(0, [f"distinct_{c}" for c in columns])


def conflicting_values(df: DataFrame, key: str, columns: Sequence[str], k: int) -> DataFrame:
    """The values themselves where a top-k key has more than one, one row each."""
    values = staged(distinct_values_per_key(repeated_rows(df, key, k), key, columns), "values")
    several = values.groupBy(key, "column").agg(F.count("*").alias("n_values")).filter("n_values > 1")
    # At most k keys times the listed columns.
    few = k * len(columns) <= FEW_KEYS
    return values.join(F.broadcast(several) if few else several, [key, "column"])


def exact_duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key combination, missing values equal."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("exact_duplicates"))


def first_value(column: str, order: str) -> Column:
    """First non-null value by the ordinal, as an aggregate."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.col(order)))


def merge_tags(df: DataFrame, key: str, columns: Sequence[str], order: str) -> DataFrame:
    """Per key and column: the distinct trimmed tags of all cells, in order of first occurrence.

    Tokens are reduced to one first position per (key, column, tag) before the shuffle, so what
    meets in one place is the tag vocabulary of a key, not its rows.
    """
    cells = F.explode(F.array(*[
        F.struct(F.lit(i).alias("column"), F.col(c).alias("cell")) for i, c in enumerate(columns)
    ]))
    tokens = (
        df.filter(F.col(key).isNotNull())
        .select(key, order, cells.alias("c"))
        .select(key, order, "c.column", F.posexplode(F.array_distinct(to_list(F.col("c.cell")))).alias("pos", "tag"))
    )
    # A tag stands once in a row's list, so its place in its first row is well defined; numbers
    # alone are kept per group, which lets Spark aggregate by hash.
    first_seen = tokens.groupBy(key, "column", "tag").agg(
        F.min(order).alias("row"), F.min_by("pos", order).alias("pos")
    )

    def listed(i: int) -> Column:
        own = F.collect_list(F.when(F.col("column") == i, F.struct("row", "pos", "tag")))
        return F.array_join(F.transform(F.array_sort(own), lambda x: x["tag"]), ";")

    return first_seen.groupBy(key).agg(*[listed(i).alias(c) for i, c in enumerate(columns)])


def one_per_key(
    df: DataFrame, key: str, order: str, first: Sequence[str], merged: Sequence[str]
) -> DataFrame:
    """One record per key: first non-null value of some columns, merged tags of others."""
    out = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        *[first_value(c, order).alias(c) for c in first]
    )
    # Both sides hold one row per key.
    out = out.join(merge_tags(df, key, merged, order), key, "left").na.fill("", list(merged))
    return out.select(key, *first, *merged)


def article_summary(df: DataFrame, company: str = "company", k: int = 5) -> DataFrame:
    """Run summary. Everything is folded per company first; the top list adds k rows."""
    per_company = df.groupBy(company).agg(
        F.count("*").alias("n"),
        F.count_if("has_image").alias("images"),
        F.count_if("has_timestamp").alias("stamps"),
        F.sum(F.col("title_length").cast("long")).alias("title_chars"),
        F.sum(F.col("snippet_length").cast("long")).alias("snippet_chars"),
        F.sum(F.col("sentiment_score").cast("long")).alias("score"),
    )
    best = (
        per_company.filter(F.col(company).isNotNull())
        .orderBy(F.desc("n"), F.asc(company)).limit(k)
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("r"), F.col(company).alias("company")))).alias("t"))
        .select(F.transform("t", lambda x: F.struct(x["company"].alias("company"), (-x["r"]).alias("n"))).alias("t"))
        .scalar()
    )
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per_company.agg(
        total.alias("total_articles"),
        F.count(company).alias("companies_covered"),
        F.coalesce(F.sum("images"), F.lit(0)).alias("articles_with_images"),
        F.coalesce(F.sum("stamps"), F.lit(0)).alias("articles_with_timestamps"),
        rate(F.sum("title_chars"), total).alias("avg_title_length"),
        rate(F.sum("snippet_chars"), total).alias("avg_snippet_length"),
        rate(F.sum("score"), total).alias("avg_sentiment_score"),
    ).withColumn("top_companies", best)


def category_distribution(df: DataFrame, category: str, relevance: str) -> DataFrame:
    """Rows and relevant rows per category."""
    return df.groupBy(category).agg(
        F.count("*").alias("n"),
        F.count_if(F.col(relevance)).alias("relevant"),
        rate(F.count_if(F.col(relevance)), F.count("*")).alias("relevant_ratio"),
    )


def list_totals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sum and mean of list sizes, and the share of rows where any list is non-empty."""
    any_hit = F.lit(False)
    for c in columns:
        any_hit = any_hit | (F.size(c) > 0)
    sums = [F.coalesce(F.sum(F.size(c)), F.lit(0)).alias(f"total_{c}") for c in columns]
    means = [rate(F.sum(F.size(c)), F.count("*")).alias(f"avg_{c}") for c in columns]
    return df.agg(
        F.count("*").alias("total_rows"), *sums, *means,
        rate(F.count_if(any_hit), F.count("*"), 100.0).alias("hit_rate_pct"),
    )


def run_report(df: DataFrame, name: str, status: str, seconds: str) -> DataFrame:
    """Success counts and rates of a crawl; every rate is 0 on empty input."""
    done = F.count("*")
    spent = F.coalesce(F.sum(seconds), F.lit(0.0))
    raw = F.count_if(F.col(name).isNotNull())
    live = F.count_if(F.col(name).isNotNull() & (F.col(status) == "ok"))
    return df.agg(
        done.alias("total"),
        raw.alias("raw_success"),
        live.alias("live_success"),
        rate(raw, done, 100.0).alias("raw_success_pct"),
        rate(live, done, 100.0).alias("live_success_pct"),
        rate(spent, done).alias("seconds_per_url"),
        rate(done, spent, 3600.0).alias("urls_per_hour"),
    )


def ledger_stats(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(F.count("*").alias("n"))


def rows_per_seed(seeds: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Row count per seed, zero for seeds without rows."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    return seeds.join(counts, key, "left").na.fill(0, ["n"])


def column_profile(df: DataFrame) -> DataFrame:
    """Rows, non-null count and type per column, in one pass."""
    counted = df.agg(F.count("*").alias("__rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(c).alias("non_null"), F.lit(t).alias("dtype"))
        for c, t in df.dtypes
    ]
    return counted.select(F.col("__rows").alias("total_rows"), F.inline(F.array(*entries)))
