"""Deterministic classifiers: struct-valued Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanwork import lexicons as lx
from gleanwork.functions.predicates import any_keyword, mentions
from gleanwork.functions.text import char_length, strip


def verdict(category: str, relevant: bool, reasoning: str) -> Column:
    return F.struct(
        F.lit(category).alias("category"),
        F.lit(relevant).alias("company_relevance"),
        F.lit(reasoning).alias("reasoning"),
    )


def too_short(title: Column) -> Column:
    return char_length(strip(title)) < lx.GATE_TITLE_CHARS


SHORT_VERDICT = ("news article", False, lx.TITLE_TOO_SHORT)


def classify_by_rules(
    title: Column,
    name: Column,
    funding_words: Sequence[str] = lx.TITLE_FUNDING_WORDS,
    feature_words: Sequence[str] = lx.TITLE_FEATURE_WORDS,
) -> Column:
    """Name missing, then funding words, then feature words, else general news."""
    return (
        F.when(~mentions(title, name), verdict("irrelevant", False, lx.NAME_NOT_IN_TITLE))
        .when(any_keyword(title, funding_words), verdict("funding", True, lx.FUNDING_FOUND))
        .when(any_keyword(title, feature_words), verdict("feature update", True, lx.FEATURE_FOUND))
        .otherwise(verdict("news article", True, lx.GENERAL_NEWS))
    )


def classify_title(title: Column, name: Column, **words: Sequence[str]) -> Column:
    """The short-title gate in front of the rules."""
    return F.when(too_short(title), verdict(*SHORT_VERDICT)).otherwise(
        classify_by_rules(title, name, **words)
    )


def normalize_answer(
    answer: Column,
    funding_words: Sequence[str] = lx.ANSWER_FUNDING_WORDS,
    feature_words: Sequence[str] = lx.ANSWER_FEATURE_WORDS,
) -> Column:
    """Map a free-text answer to one of three categories."""
    text = strip(F.lower(answer))
    return (
        F.when(text.isin(*lx.ANSWER_FEATURE_ALIASES), "feature update")
        .when(text.isin(*lx.ANSWER_FUNDING_ALIASES), "funding")
        .when(text.isin(*lx.ANSWER_NEWS_ALIASES), "news article")
        .when(any_keyword(text, funding_words), "funding")
        .when(any_keyword(text, feature_words), "feature update")
        .otherwise("news article")
    )


def _hits(text: Column, keywords: Sequence[str]) -> Column:
    """Title-cased keywords found in the text, sorted and distinct."""
    found = [F.when(F.contains(text, F.lit(k)), F.initcap(F.lit(k))) for k in sorted(keywords)]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))


def is_blank(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit(""))) == ""


def _no_names() -> Column:
    return F.array().cast("array<string>")


def affiliation(companies: Column, universities: Column, primary: Column, reasoning: str) -> Column:
    return F.struct(
        companies.alias("companies"),
        universities.alias("universities"),
        primary.alias("primary_affiliation"),
        F.lit(reasoning).alias("reasoning"),
    )


def blank_affiliation() -> Column:
    return affiliation(_no_names(), _no_names(), F.lit(lx.NO_AFFILIATION), lx.EMPTY_AFFILIATION)


def extract_affiliation(
    text: Column,
    company_keywords: Sequence[str] = lx.COMPANY_KEYWORDS,
    university_keywords: Sequence[str] = lx.UNIVERSITY_KEYWORDS,
) -> Column:
    """Companies and universities named in a free-text affiliation, by keyword."""
    lower = F.lower(text)
    found = affiliation(
        _hits(lower, company_keywords), _hits(lower, university_keywords), text,
        lx.KEYWORD_MATCH,
    )
    return F.when(is_blank(text), blank_affiliation()).otherwise(found)


def affiliation_fallback(text: Column) -> Column:
    """No usable response: nothing found, the text itself is the affiliation."""
    raw = affiliation(_no_names(), _no_names(), text, lx.EXTRACTION_FALLBACK)
    return F.when(is_blank(text), blank_affiliation()).otherwise(raw)
