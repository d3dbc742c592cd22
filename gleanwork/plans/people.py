"""People: profile cards to rows, affiliations to organisations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork import lexicons as lx
from gleanwork.functions import responses, rules, text
from gleanwork.operators import enrich, extract, page_specs
from gleanwork.session import staged


def profile_rows(pages: DataFrame) -> DataFrame:
    """Profile cards of listing pages, control characters removed."""
    rows = extract.extract_records(pages, page_specs.PROFILES)
    cleaned = ["name", "affiliation", "email", "citations", "research_interests"]
    return rows.withColumns({c: text.remove_control_chars(F.col(c)) for c in cleaned})


def labelled_profile_rows(pages: DataFrame, scraped_at: str = "current_timestamp()") -> DataFrame:
    """Second variant: keeps the page's label, tab and page number and a collection time."""
    rows = extract.extract_records(pages, page_specs.PROFILES_LABELLED)
    return rows.withColumn("scraped_at", F.expr(scraped_at))


def affiliations(
    people: DataFrame, infer: enrich.Infer | None = None, spread_by: Sequence[str] | None = None,
    store: str | None = None,
) -> DataFrame:
    """Companies and universities per person, by keywords or by a model.

    With a model: blank texts are not asked, unusable answers fall back to the raw text, and a
    failed call is recorded as such.
    """
    source = people.withColumnRenamed("affiliation", "original_affiliation")
    raw = F.col("original_affiliation")
    if infer is None:
        return enrich.widen(source.withColumn("__r", rules.extract_affiliation(raw)), "__r")
    prompt = F.when(~rules.is_blank(raw), text.fill(lx.AFFILIATION_PROMPT, name=F.col("name"), affiliation=raw))
    asked = enrich.enrich_distinct(source, prompt, infer, spread_by=spread_by, store=store)
    none = F.array().cast("array<string>")
    failed = F.struct(
        none.alias("companies"), none.alias("universities"),
        F.lit(lx.EXTRACTION_FAILED).alias("primary_affiliation"), F.left("error", F.lit(lx.MAX_REASON_CHARS)).alias("reasoning"),
    )
    answered = responses.affiliation_or_fallback(F.col("response"), raw)
    judged = asked.withColumn("__r", F.when(F.col("error").isNotNull(), failed).otherwise(answered))
    return enrich.widen(judged.drop("response", "error"), "__r")


def people_run(pages: DataFrame, infer: enrich.Infer | None = None) -> DataFrame:
    """Listing pages to affiliations. The `N/A` a profile may carry counts as missing, as it does
    when the collected rows are read back from a file."""
    profiles = profile_rows(pages).replace(lx.NOT_AVAILABLE, None, ["affiliation"])
    named = profiles.select("name", "affiliation")
    # With a model the rows are read twice, for the prompts and for the answers.
    return affiliations(named if infer is None else staged(named, "profiles"), infer)
