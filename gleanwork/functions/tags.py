"""Semicolon-separated tag cells.

Adding and upserting follow different token rules on purpose: `add_tag` compares untrimmed
lower-cased tokens, `upsert_tag` trimmed case-sensitive ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanwork.functions.text import strip

SEP = ";"


def to_list(c: Column) -> Column:
    """Trimmed non-blank tokens; null gives an empty list."""
    tokens = F.filter(F.transform(F.split(c, SEP), strip), lambda x: x != "")
    return F.coalesce(tokens, F.array().cast("array<string>"))


def _strip_seps(c: Column) -> Column:
    return strip(F.trim(c, F.lit(SEP)))


def remove_keywords(c: Column, keywords: Sequence[str]) -> Column:
    """Delete each keyword as a substring, in order, then tidy separators once."""
    for kw in keywords:
        for piece in (SEP + kw, kw + SEP, kw):
            c = F.replace(c, F.lit(piece), F.lit(""))
    return _strip_seps(F.replace(c, F.lit(SEP * 2), F.lit(SEP)))


def add_tag(c: Column, tag: str) -> Column:
    clean = _strip_seps(F.coalesce(c, F.lit("")))
    known = F.array_contains(F.split(F.lower(clean), SEP), tag)
    return (
        F.when(known, clean)
        .when(clean != "", F.concat(clean, F.lit(SEP + tag)))
        .otherwise(F.lit(tag))
    )


def upsert_tag(c: Column, tag: str, verdict: Column) -> Column:
    """Append the tag on a true verdict, drop every copy of it on a false one."""
    tokens = to_list(c)
    kept = F.filter(tokens, lambda x: x != tag)
    added = F.when(F.array_contains(tokens, tag), tokens).otherwise(
        F.concat(tokens, F.array(F.lit(tag)))
    )
    merged = F.when(F.coalesce(verdict, F.lit(False)), added).otherwise(kept)
    prefix = F.when(F.startswith(c, F.lit(SEP)), SEP).otherwise("")
    return F.concat(prefix, F.array_join(merged, SEP))


def rename_tag(c: Column, old: str, new: str) -> Column:
    """Literal replacement inside the cell; running it again prefixes again."""
    return F.replace(c, F.lit(old), F.lit(new))
