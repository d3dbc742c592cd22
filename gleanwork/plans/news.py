"""News: seeds and result pages to classified, de-duplicated article rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork import lexicons as lx
from gleanwork.functions import predicates, responses, rules, text
from gleanwork.operators import aggregates, dedup, enrich, extract, joins, page_specs
from gleanwork.session import staged

PROMPT = """Tool: {tool_name}
Headline: "{title}"

Judge the headline alone. Say whether it concerns the tool itself, and which one label fits:
feature update (something the tool newly does or offers), funding (money raised, invested or reported),
news article (anything else concerning the tool), irrelevant (does not concern the tool).
Answer with one JSON object: category (a label), company_relevance (true or false), reasoning (one sentence)."""


LABEL_PROMPT = """Headline: "{title}"
Which label fits best: feature update, funding or news article?
Reply with the label alone."""


def article_rows(pages: DataFrame) -> DataFrame:
    """Article cards of result pages that carry tool columns and a page ordinal."""
    cards = extract.extract_records(pages, page_specs.ARTICLE_ADVANCED)
    return cards.filter(predicates.valid_title(F.col("title")))


def with_tool(
    df: DataFrame, seeds: DataFrame, order: str = "tool_id", spread_by: Sequence[str] | None = None
) -> DataFrame:
    """`spread_by`: a row ordinal, for a tool that owns a large share of the rows."""
    return joins.lookup_last(df, seeds, "tool_name", ["tool_id", "tool_url"], order, spread_by=spread_by)


def features(
    df: DataFrame, positive: Sequence[str] = lx.POSITIVE_WORDS, negative: Sequence[str] = lx.NEGATIVE_WORDS
) -> DataFrame:
    """Lengths, image flag and presence-based sentiment."""
    title = F.col("title")
    return df.withColumns({
        "title_length": text.char_length(title),
        "snippet_length": text.char_length(F.col("snippet")),
        "has_image": text.is_present(F.col("image_url"), lx.NO_IMAGE),
        "positive_words": text.presence_count(title, positive),
        "negative_words": text.presence_count(title, negative),
    }).withColumn("sentiment_score", F.col("positive_words") - F.col("negative_words"))


def features_advanced(
    df: DataFrame, positive: Sequence[str] = lx.POSITIVE_WORDS, negative: Sequence[str] = lx.NEGATIVE_WORDS
) -> DataFrame:
    """Adds decoded title and timestamp flag; sentiment counts occurrences."""
    title = F.col("title")
    return df.withColumns({
        "title_length": text.char_length(title),
        "snippet_length": text.char_length(F.col("snippet")),
        "has_image": text.is_present(F.col("image_url"), lx.NO_IMAGE),
        "has_timestamp": text.is_present(F.col("timestamp"), lx.NO_TIMESTAMP),
        "cleaned_title": text.decode_entities(F.coalesce(title, F.lit(""))),
        "positive_words": text.occurrence_count(title, positive),
        "negative_words": text.occurrence_count(title, negative),
    }).withColumn("sentiment_score", F.col("positive_words") - F.col("negative_words"))


def classify(
    df: DataFrame,
    infer: enrich.Infer | None = None,
    keep_all_when_none: bool = False,
    spread_by: Sequence[str] | None = None,
    store: str | None = None,
    **words: Sequence[str],
) -> DataFrame:
    """Adds `category` and `company_relevance`, keeping relevant rows only.

    Rows whose title lacks the tool name are dropped before anything is asked. With
    `keep_all_when_none`, if that would drop every row, all of them are returned as irrelevant
    instead; the rows are staged for it, as they are read twice. `spread_by`: a row ordinal, for
    titles that were not de-duplicated. `store`: a table that keeps the model's answers.
    """
    title, name = F.col("title"), F.col("tool_name")
    flagged = df.withColumn("__in_title", predicates.mentions(title, name))
    if keep_all_when_none:
        flagged = staged(flagged, "flagged")
    named = flagged.filter("__in_title")
    if infer is None:
        judged = named.withColumn("__v", rules.classify_title(title, name, **words))
    else:
        judged = _judge_by_model(named, infer, spread_by, store, words)
    relevant = judged.filter("__v.company_relevance").select(
        *df.columns, F.col("__v.category").alias("category"),
        F.col("__v.company_relevance").alias("company_relevance"),
    )
    if not keep_all_when_none:
        return relevant
    any_named = flagged.agg(F.max("__in_title").alias("any")).scalar()
    rest = flagged.filter(~any_named).select(
        *df.columns, F.lit("irrelevant").alias("category"), F.lit(False).alias("company_relevance")
    )
    return relevant.unionByName(rest)


def _judge_by_model(named: DataFrame, infer: enrich.Infer, spread_by, store, words) -> DataFrame:
    """Short titles never reach the model; a failed call means general news, not relevant."""
    title, name = F.col("title"), F.col("tool_name")
    prompt = F.when(~rules.too_short(title), text.fill(PROMPT, tool_name=name, title=title))
    asked = enrich.enrich_distinct(named, prompt, infer, spread_by=spread_by, store=store)
    answered = responses.article_class_or_rules(F.col("response"), title, name, **words)
    failed = rules.verdict("news article", False, "Classification failed")
    verdict = F.when(F.col("error").isNotNull(), failed).otherwise(answered)
    return asked.withColumn("__v", verdict).drop("response", "error")


def label_titles(
    df: DataFrame, infer: enrich.Infer, spread_by: Sequence[str] | None = None, store: str | None = None,
    **words: Sequence[str],
) -> DataFrame:
    """Three-way `category` from free-text answers. Short titles and failures are general news."""
    title = F.col("title")
    prompt = F.when(~rules.too_short(title), text.fill(LABEL_PROMPT, title=title))
    asked = enrich.enrich_distinct(df, prompt, infer, spread_by=spread_by, store=store)
    return asked.withColumn("category", rules.normalize_answer(F.col("response"), **words)).drop("response", "error")


def news_run(articles: DataFrame, order: str, infer: enrich.Infer | None = None, **words) -> DataFrame:
    """Features, exact-title dedup, classification, relevance filter."""
    unique = dedup.dedup_exact_title(articles, "title", order)
    return classify(features(unique), infer, **words)


def from_pages(
    pages: DataFrame, seeds: DataFrame, order: str, infer: enrich.Infer | None = None, **words
) -> DataFrame:
    """The whole run: cards of result pages, tool columns, features, dedup, verdicts, output columns.

    `pages` has `html`, `tool_name` and an ordinal; articles are ordered by page, then position.
    Rows are staged once, after the dedup. Tool columns are looked up last, when only relevant
    rows are left.
    """
    cards = article_rows(pages.select(order, "tool_name", "html"))
    rows = news_run(cards.withColumn("ord", F.struct(order, "pos")), "ord", infer, keep_all_when_none=True, spread_by=["ord"], **words)
    return output_rows(with_tool(rows, seeds, spread_by=["ord"]))


def run_counts(articles: DataFrame, order: str, **words) -> DataFrame:
    """How many rows each stage leaves: collected, unique titles, naming the tool, relevant."""
    title, name = F.col("title"), F.col("tool_name")
    unique = dedup.dedup_exact_title(articles, "title", order)
    named = predicates.mentions(title, name)
    relevant = rules.classify_title(title, name, **words)["company_relevance"]
    collected = articles.agg(F.count("*").alias("n")).scalar()
    return unique.agg(
        F.count("*").alias("unique_titles"), F.count_if(named).alias("naming_tool"),
        F.count_if(named & relevant).alias("relevant"),
    ).select(
        F.coalesce(collected, F.lit(0)).alias("collected"), "unique_titles", "naming_tool", "relevant",
        (F.col("unique_titles") - F.col("naming_tool")).alias("filtered_before"),
        (F.col("naming_tool") - F.col("relevant")).alias("filtered_after"),
    )


def output_rows(df: DataFrame) -> DataFrame:
    """The fixed output columns, sentinels in place."""
    named = df.withColumnRenamed("category", "ollama_category")
    filled = named.na.fill({
        "link": lx.NO_LINK, "image_url": lx.NO_IMAGE, "source": lx.NO_SOURCE, "snippet": lx.NO_SNIPPET
    })
    return filled.select(*lx.ARTICLE_FIELDS)


def run_summary(df: DataFrame) -> DataFrame:
    return aggregates.article_summary(df)
