"""Row predicates. All of them return false, never null, on missing text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanwork import lexicons as lx
from gleanwork.functions.text import strip

# Word characters are letters, numbers and underscore of any script.
WORD_START = r"(^|[^\p{L}\p{N}_])"
WORD_END = r"($|[^\p{L}\p{N}_])"


def _false_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def any_keyword(c: Column, keywords: Sequence[str], case_sensitive: bool = False) -> Column:
    """Any keyword is a substring. Long lists: see `operators.keywords.match_substrings`."""
    text = c if case_sensitive else F.lower(c)
    words = keywords if case_sensitive else [k.lower() for k in keywords]
    return _false_if_null(_any([F.contains(text, F.lit(k)) for k in words]))


def word_pattern(keywords: Sequence[str], escape: bool = False) -> str:
    """Whole-word alternation. Keywords are patterns unless `escape` is set."""
    words = [_escaped(k) if escape else k for k in keywords]
    return WORD_START + "(?:" + "|".join(words) + ")" + WORD_END


def _escaped(word: str) -> str:
    return "".join("\\" + ch if ch in r"\.^$|?*+()[]{}-" else ch for ch in word)


def any_word(c: Column, keywords: Sequence[str], escape: bool = False) -> Column:
    """Any keyword as a whole word. Long lists: see `operators.keywords.match_terms` and `match_patterns`."""
    if not keywords:
        return F.lit(False)
    return _false_if_null(F.rlike(c, F.lit("(?iu)" + word_pattern(keywords, escape))))


def text_contains(c: Column, keyword: str, regex: bool = False) -> Column:
    """Keyword or pattern in the stringified cell, ignoring case, where a missing cell reads `nan`."""
    cell = F.coalesce(c.cast("string"), F.lit("nan"))
    if regex:
        return F.rlike(cell, F.lit("(?iu)" + keyword))
    return F.contains(F.lower(cell), F.lit(keyword.lower()))


def differs(a: Column, b: Column) -> Column:
    """True also when either side is missing, both sides included."""
    return a.isNull() | b.isNull() | (a != b)


def valid_title(title: Column, min_chars: int = lx.MIN_TITLE_CHARS) -> Column:
    return _false_if_null((F.length(title) >= min_chars) & (title != lx.NO_TITLE))


def mentions(title: Column, name: Column) -> Column:
    return _false_if_null(F.contains(F.lower(title), F.lower(name)))


def has_suffix(c: Column, suffix: str) -> Column:
    return _false_if_null(F.endswith(F.lower(strip(c)), F.lit(suffix)))


def visible_text(html: Column) -> Column:
    """What stands between the tags, scripts and styles left out."""
    return F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>", " ")


def page_status(
    url: Column, title: Column, heading: Column, html: Column, captcha_words: Sequence[str] = lx.CAPTCHA_WORDS
) -> Column:
    """login / captcha / blocked / dead / ok. Detection only.

    Which words give a challenge page away depends on the kind of page; they are looked for in its
    visible text.
    """
    return (
        F.when(any_keyword(url, lx.LOGIN_MARKERS, case_sensitive=True), "login")
        .when(any_keyword(visible_text(html), captcha_words), "captcha")
        .when(_false_if_null(F.contains(title, F.lit(lx.BLOCK_TITLE))), "blocked")
        .when(_false_if_null(strip(heading) == lx.DEAD_HEADING), "dead")
        .otherwise("ok")
    )
