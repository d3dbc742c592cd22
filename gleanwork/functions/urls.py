"""URL building and resolution."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanwork import lexicons as lx


def form_encode(c: Column) -> Column:
    """Form encoding with `~` kept and `*` escaped, unlike the JVM encoder."""
    coded = F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~"))
    return F.replace(coded, F.lit("*"), F.lit("%2A"))


def search_url(name: Column, page: Column, prefix: str = lx.SEARCH_URL, page_size: int = 10) -> Column:
    """Quoted-phrase query URL with a result offset."""
    return F.concat(
        F.lit(prefix),
        form_encode(F.concat(F.lit('"'), name, F.lit('"'))),
        F.lit("&first="),
        page_offset(page, page_size).cast("string"),
    )


def page_offset(page: Column, page_size: int = 10) -> Column:
    return (page - 1) * page_size


def listing_url(base: Column, page_index: Column, page_size: int = 10) -> Column:
    """Zero-based listing page: the first one carries no offset parameter."""
    offset = (page_index * page_size).cast("string")
    return F.when(page_index == 0, base).otherwise(F.concat(base, F.lit("&astart="), offset))


def looks_like_url(c: Column) -> Column:
    return F.contains(c, F.lit(".")) & F.contains(c, F.lit("/"))


def _without_dots(path: Column, keep_empty: bool) -> Column:
    """Resolve `.` and `..` in a rooted path; empty inner segments may be dropped."""
    segments = F.split(F.substring(path, F.lit(2), F.length(path)), "/")
    last = F.element_at(segments, -1)
    if not keep_empty:
        inner = F.filter(F.slice(segments, F.lit(1), F.size(segments) - 1), lambda s: s != "")
        segments = F.concat(inner, F.array(last))
    stack = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.concat(acc, F.array(s))),
    )
    closed = F.when(last.isin(".", ".."), F.concat(stack, F.array(F.lit("")))).otherwise(stack)
    return F.concat(F.lit("/"), F.array_join(closed, "/"))


def absolute_url(base: Column, href: Column) -> Column:
    """Resolve a link against its page. Empty link: the page itself; null link: null."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    host = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    base_path = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_extract(base_path, r"^(.*/)[^/]*$", 1)
    no_fragment = F.regexp_extract(base, r"^([^#]*)", 1)
    no_query = F.regexp_extract(base, r"^([^?#]*)", 1)
    href_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    href_rest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    rooted = F.concat(host, _without_dots(href_path, keep_empty=True), href_rest)
    below = F.concat(F.when(folder == "", "/").otherwise(folder), href_path)
    relative = F.concat(host, _without_dots(below, keep_empty=False), href_rest)
    return (
        F.when(href == "", base)
        .when(F.rlike(href, F.lit(r"^[a-zA-Z][a-zA-Z0-9+.-]*:")), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(F.startswith(href, F.lit("/")), rooted)
        .when(F.startswith(href, F.lit("?")), F.concat(no_query, href))
        .when(F.startswith(href, F.lit("#")), F.concat(no_fragment, href))
        .when(href.isNotNull(), relative)
    )
