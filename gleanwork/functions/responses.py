"""Validation of collected model responses (JSON text) on the VARIANT type.

`from_json` turns wrong types into text or null without saying so; a variant keeps the type
that was sent, so required fields are checked by type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork import lexicons as lx
from gleanwork.functions import rules
from gleanwork.functions.text import strip


def strict_json(c: Column) -> Column:
    """The variant of a text that is one whole JSON value, else null.

    The parser stops after the first value. Text behind it can complete an array or an
    object around the value, not both, so both wrappings must parse.
    """
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}")))
    in_array = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    return F.when(in_object.isNotNull(), F.try_variant_get(in_array, "$[0]", "variant"))


def _with_json(content: Column, build: Callable[[Column], Column]) -> Column:
    """Apply `build` to the parsed content, parsed once however often `build` reads it."""
    return F.get(F.transform(F.array(strict_json(content)), build), F.lit(0))


def _field(v: Column, name: str) -> tuple[Column, Column]:
    """(field, its type name); an absent field has a null type."""
    field = F.try_variant_get(v, f"$.{name}", "variant")
    return field, F.schema_of_variant(field)


def _text(v: Column, name: str) -> Column:
    field, kind = _field(v, name)
    return F.when(kind == "STRING", field.try_cast("string"))


def _is_number(kind: Column) -> Column:
    return (kind == "BIGINT") | F.startswith(kind, F.lit("DECIMAL")) | (kind == "DOUBLE")


def _lenient_bool(v: Column, name: str) -> Column:
    """true/false, 0/1, or one of the accepted words."""
    field, kind = _field(v, name)
    word = F.lower(field.try_cast("string"))
    number = field.try_cast("double")
    return (
        F.when(kind == "BOOLEAN", field.try_cast("boolean"))
        .when(_is_number(kind), F.when(number == 1, True).when(number == 0, False))
        .when(
            kind == "STRING",
            F.when(word.isin("true", "t", "yes", "y", "on", "1"), True)
            .when(word.isin("false", "f", "no", "n", "off", "0"), False),
        )
    )


def _text_list(v: Column, name: str) -> Column:
    field, kind = _field(v, name)
    empty = F.array().cast("array<string>")
    return F.when(kind == "ARRAY<STRING>", field.try_cast("array<string>")).when(
        (kind == "ARRAY<VOID>") & (field.try_cast("string") == "[]"), empty
    )


def _all_or_null(**fields: Column) -> Column:
    complete = F.lit(True)
    for f in fields.values():
        complete = complete & f.isNotNull()
    return F.when(complete, F.struct(*[f.alias(n) for n, f in fields.items()]))


def parse_article_class(content: Column) -> Column:
    """Validated classification, or null."""

    def fields(v: Column) -> Column:
        category = _text(v, "category")
        return _all_or_null(
            category=F.when(category.isin(*lx.CATEGORIES), category),
            company_relevance=_lenient_bool(v, "company_relevance"),
            reasoning=_text(v, "reasoning"),
        )

    return _with_json(content, fields)


def parse_use_check(content: Column, flag: str = "relevant") -> Column:
    """struct<relevant, reason>: the flag is required, `reason` may be missing; null when invalid."""

    def fields(v: Column) -> Column:
        relevant = _lenient_bool(v, flag)
        reason, kind = _field(v, "reason")
        reason_ok = kind.isNull() | kind.isin("STRING", "VOID")
        return F.when(
            relevant.isNotNull() & reason_ok,
            F.struct(relevant.alias("relevant"), reason.try_cast("string").alias("reason")),
        )

    return _with_json(content, fields)


def parse_affiliation(content: Column) -> Column:
    return _with_json(content, lambda v: _all_or_null(
        companies=_text_list(v, "companies"),
        universities=_text_list(v, "universities"),
        primary_affiliation=_text(v, "primary_affiliation"),
        reasoning=_text(v, "reasoning"),
    ))


def recover_affiliation(content: Column) -> Column:
    """The whole text, else the first block naming both keys, else null."""
    block = F.regexp_extract(content, lx.AFFILIATION_BLOCK, 0)
    return F.coalesce(parse_affiliation(content), parse_affiliation(block))


def affiliation_or_fallback(content: Column, text: Column) -> Column:
    blank = rules.is_blank(text)
    return F.when(blank, rules.blank_affiliation()).otherwise(
        F.coalesce(recover_affiliation(content), rules.affiliation_fallback(text))
    )


def article_class_or_rules(content: Column, title: Column, name: Column, **words) -> Column:
    """Gate, then a valid response, then the rules."""
    return F.when(rules.too_short(title), rules.verdict(*rules.SHORT_VERDICT)).otherwise(
        F.coalesce(parse_article_class(content), rules.classify_by_rules(title, name, **words))
    )


def parse_evidence(content: Column) -> Column:
    """`supports` by truthiness, `evidence` as text; null when either key is absent."""

    def fields(v: Column) -> Column:
        supports, kind = _field(v, "supports")
        evidence, evidence_kind = _field(v, "evidence")
        truth = (
            F.when(kind == "VOID", False)
            .when(kind == "BOOLEAN", supports.try_cast("boolean"))
            .when(_is_number(kind), supports.try_cast("double") != 0)
            .otherwise(~supports.try_cast("string").isin("", "[]", "{}"))
        )
        shown = F.when(evidence_kind == "VOID", "None").otherwise(evidence.try_cast("string"))
        return F.when(
            kind.isNotNull() & evidence_kind.isNotNull(),
            F.struct(truth.alias("supports"), shown.alias("evidence")),
        )

    return _with_json(content, fields)


def definition_text(status: Column, body: Column) -> Column:
    """First definition of the first meaning, with the fixed texts for each way to miss it."""

    def first_definition(v: Column) -> Column:
        entry = F.try_variant_get(v, "$[0]", "variant")
        kind = F.schema_of_variant(entry)
        meanings = F.schema_of_variant(F.try_variant_get(entry, "$.meanings", "variant"))
        found = F.try_variant_get(entry, "$.meanings[0].definitions[0].definition", "string")
        unreadable = (
            entry.isNull()
            | ~F.startswith(kind, F.lit("OBJECT"))
            | (meanings.isNotNull() & ~F.startswith(meanings, F.lit("ARRAY")))
        )
        return F.when(unreadable, lx.UNREADABLE_DEFINITION).otherwise(
            F.coalesce(found, F.lit(lx.NO_DEFINITION))
        )

    failed = F.concat(F.lit("Error: "), status.cast("string"), F.lit(" - "), body)
    return F.when(status != 200, failed).otherwise(_with_json(body, first_definition))


def split_valid(df: DataFrame, parsed: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantine) by whether the parsed column is null."""
    return df.filter(F.col(parsed).isNotNull()), df.filter(F.col(parsed).isNull()).drop(parsed)


def require_valid(parsed: Column, content: Column) -> Column:
    """Fail the job on an invalid response instead of quarantining it."""
    message = F.concat(F.lit("Invalid response: "), F.coalesce(strip(content), F.lit("null")))
    return F.coalesce(parsed, F.raise_error(message))
