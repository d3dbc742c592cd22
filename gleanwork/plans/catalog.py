"""Catalogue: ranking and profile tables to one clean record per tool."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork import lexicons as lx
from gleanwork.functions import responses, tags
from gleanwork.operators import aggregates, dedup, enrich, joins

USE_CASES = {
    name: enrich.UseCase(name, name, words, whole_word=whole, tag_column=column)
    for table, whole, column in (
        (lx.ORIGINAL_USE_KEYWORDS, False, "use_original"),
        (lx.AGGREGATED_USE_KEYWORDS, False, "use_aggregated"),
        (lx.WORD_USE_KEYWORDS, True, "use_aggregated"),
    )
    for name, words in table.items()
}


def catalogue(ranking: DataFrame, profile: DataFrame, **options) -> DataFrame:
    """Ranking joined to profile on tool_id, narrowed to the working columns."""
    return joins.merge(ranking, profile, "tool_id", **options).select(*lx.CATALOG_FIELDS)


def cohort(base: DataFrame, name: str) -> DataFrame:
    """The rows one of the known uses suggests."""
    case = USE_CASES[name]
    return base.filter(case.suggests(case.tag_column))


def remove_tags(
    base: DataFrame, keywords: Sequence[str], tool_ids: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Delete keywords from the aggregated uses, of all tools or of the listed ones."""
    cleaned = tags.remove_keywords(F.col("use_aggregated"), keywords)
    if tool_ids is None:
        return base.withColumn("use_aggregated", cleaned)
    return joins.update_from(base, tool_ids, "tool_id", {"use_aggregated": cleaned}, spread_by)


def add_tag_to(
    base: DataFrame, edits: DataFrame, tag: str, spread_by: Sequence[str] | None = None
) -> DataFrame:
    """Add a tag to every base row of the tools in `edits`, by tool_id."""
    edit = {"use_aggregated": tags.add_tag(F.col("use_aggregated"), tag)}
    return joins.update_from(base, edits, "tool_id", edit, spread_by)


def unique_uses(base: DataFrame, order: str) -> DataFrame:
    return dedup.keep_first(base, ["tool_id", "use_original"], [order])


def first_per_tool(base: DataFrame, order: str) -> DataFrame:
    return dedup.keep_first(base, ["tool_id"], [order])


def merged_tools(base: DataFrame, order: str) -> DataFrame:
    """One record per tool: first non-null texts, all uses merged in order."""
    return aggregates.one_per_key(
        base, "tool_id", order, ["name_tool", "tool_url_y", "tool_description"],
        ["use_original", "use_aggregated"],
    )


def curate_and_merge(
    base: DataFrame, case: enrich.UseCase, order: str, infer: enrich.Infer | None = None, store: str | None = None
) -> DataFrame:
    """Curate one use, repair the tags of its cohort in place, one record per tool.

    A cell depends on its own row alone: without a model nothing is joined, with one only its
    answers are, once per distinct prompt.
    """
    cohort = case.suggests(case.tag_column)
    if infer is None:
        judged, relevant = base, case.suggests(case.text_column)
    else:
        asked = enrich.enrich_distinct(base, F.when(cohort, case.prompt()), infer, spread_by=[order], store=store)
        parsed = responses.require_valid(
            responses.parse_use_check(F.col("response"), case.answer_flag), F.col("response"))
        judged = asked.withColumn("__r", F.when(cohort, parsed))
        relevant = F.col("__r.relevant")
    tag = F.col(case.tag_column)
    edited = F.when(cohort, tags.upsert_tag(tag, case.target_tag, relevant)).otherwise(tag)
    return merged_tools(judged.withColumn(case.tag_column, edited).select(*base.columns), order)
