"""Text features and cleaning as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanwork import lexicons as lx


def strip(c: Column) -> Column:
    """Trim every Unicode blank from both ends (plain `trim` takes U+0020 only)."""
    return F.trim(c, F.lit(lx.WHITESPACE))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(lx.WHITESPACE))


def normalized_key(c: Column) -> Column:
    return strip(F.lower(c))


def char_length(c: Column) -> Column:
    """Code points, null counted as empty text."""
    return F.length(F.coalesce(c, F.lit("")))


def is_present(c: Column, sentinel: str) -> Column:
    return F.coalesce(c, F.lit(sentinel)) != sentinel


def decode_entities(c: Column) -> Column:
    """Five basic entities; `&amp;` goes last so nothing is decoded twice."""
    for entity, char in lx.HTML_ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def _add(parts: list[Column]) -> Column:
    total = F.lit(0)
    for part in parts:
        total = total + part
    return total


def occurrence_count(c: Column, words: Sequence[str]) -> Column:
    """Non-overlapping occurrences of every word in the lower-cased text, summed."""
    text = F.lower(F.coalesce(c, F.lit("")))
    return _add([
        ((F.length(text) - F.length(F.replace(text, F.lit(w), F.lit("")))) / len(w)).cast("int")
        for w in words
    ])


def presence_count(c: Column, words: Sequence[str]) -> Column:
    """How many of the words occur at least once as a substring of the lower-cased text."""
    text = F.lower(F.coalesce(c, F.lit("")))
    return _add([F.contains(text, F.lit(w)).cast("int") for w in words])


def remove_control_chars(c: Column) -> Column:
    return F.regexp_replace(c, lx.CONTROL_CHARS, "")


def capture(c: Column, pattern: str, default: str | None) -> Column:
    """First capture group, or the default when nothing matches."""
    return F.coalesce(F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")), F.lit(default))


def total_review_count(c: Column) -> Column:
    return capture(c, lx.ALL_TIME_REVIEWS, lx.NOT_AVAILABLE)


def recent_review_count(c: Column) -> Column:
    return capture(c, lx.RECENT_REVIEWS, lx.NOT_AVAILABLE)


def helpful_count(c: Column) -> Column:
    return capture(c, lx.HELPFUL_COUNT, "0")


def review_time(c: Column) -> Column:
    """The `datetime` attribute of a review; unreadable text becomes null."""
    return F.try_to_timestamp(c)


def join_list(c: Column, sep: str = "; ") -> Column:
    return F.array_join(c, sep)


def bullet_list(c: Column) -> Column:
    return F.when(F.size(c) > 0, F.concat(F.lit("- "), F.array_join(c, "\n- "))).otherwise("")


def title_case(c: Column) -> Column:
    return F.initcap(c)


def truncate(c: Column, n: int) -> Column:
    return F.left(c, F.lit(n))


def path_stem(c: Column) -> Column:
    """File name without directories and without its last extension."""
    name = F.element_at(F.split(c, "/"), -1)
    stem = F.regexp_extract(name, r"^(.+)\.[^.]+$", 1)
    return F.when(stem == "", name).otherwise(stem)


def html_title(html: Column) -> Column:
    """Text of the first title element, or null."""
    return F.nullif(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit(""))


def fill(template: str, **columns: Column) -> Column:
    """Build a prompt: `{name}` placeholders are replaced by columns, null by nothing."""
    parts: list[Column] = []
    rest = template
    while rest:
        hits = [(rest.find("{" + n + "}"), n) for n in columns if "{" + n + "}" in rest]
        if not hits:
            parts.append(F.lit(rest))
            break
        at, name = min(hits)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(F.coalesce(columns[name].cast("string"), F.lit("")))
        rest = rest[at + len(name) + 2:]
    return F.concat(*parts)


def run_stamp(ts: Column, pattern: str = "yyyyMMdd_HHmmss") -> Column:
    return F.date_format(ts, pattern)


def next_run(start: Column, hours: int) -> Column:
    return start + F.make_dt_interval(hours=F.lit(hours))


def seconds_between(start: Column, end: Column) -> Column:
    return end.cast("double") - start.cast("double")


def rate(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """numerator / denominator * scale, 0 when the denominator is 0 or null."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")) * scale, F.lit(0.0)
    )
