"""What to pull out of each kind of page. Selectors, cascades and defaults are fixed values."""

from __future__ import annotations

from gleanwork import lexicons as lx
from gleanwork.operators.extract import El, RecordSpec, Take


def _cls(tag: str | None, *names: str, **more) -> El:
    return El(tag, classes=names, **more)


def _testid(value: str) -> El:
    return El("div", equals=(("data-testid", value),))


# --- fixed values: article cards, basic ----------------------------------------------------
_BASIC_TITLE = (_cls("a", "title"), El("a"))
ARTICLE_BASIC = RecordSpec(
    containers=(_cls("div", "news-card-body"), _cls("div", "t_s")),
    fields=(
        Take("title", _BASIC_TITLE, default=lx.NO_TITLE),
        Take("link", _BASIC_TITLE, "href", default=lx.NO_LINK),
        Take("image_url", (El("img"),), "src", default=lx.NO_IMAGE),
        Take("source", (_cls("div", "source"), _cls("div", "source-card")), default=lx.NO_SOURCE),
        Take("snippet", (_cls("div", "snippet"), _cls("div", "snippet-card")), default=lx.NO_SNIPPET),
    ),
)

# --- fixed values: article cards, advanced -------------------------------------------------
_TITLE = (_cls("a", "title"), El("a", contains=(("href", "news"),)), El("a"))
ARTICLE_ADVANCED = RecordSpec(
    containers=(
        _cls("div", "news-card-body"), _cls("div", "t_s"), _cls("div", "news-card"),
        _cls("article", "news-card"), _testid("news-card"),
    ),
    fields=(
        Take("title", _TITLE, default=lx.NO_TITLE),
        Take("link", _TITLE, "href", default=lx.NO_LINK),
        Take("image_url", (El("img"),), "src", default=lx.NO_IMAGE),
        Take(
            "source",
            (_cls("div", "source"), _cls("div", "source-card"), _cls("span", "source"), _testid("source")),
            default=lx.NO_SOURCE,
        ),
        Take(
            "snippet",
            (_cls("div", "snippet"), _cls("div", "snippet-card"), _cls("p", "snippet"), _testid("snippet")),
            default=lx.NO_SNIPPET,
        ),
        Take(
            "timestamp",
            (_cls("div", "timestamp"), _cls("span", "timestamp"), El("time"), _testid("timestamp")),
            default=lx.NO_TIMESTAMP,
        ),
    ),
)

# --- fixed values: product page ------------------------------------------------------------
_LINE_CLASSES = (("class", "max-w-[260px]"), ("class", "truncate"), ("class", "font-semibold"))
PRODUCT_PAGE = RecordSpec(
    fields=(
        Take("page_title", (El("title"),), "words"),
        Take(
            "product_name",
            (
                El("h1"), _cls("h1", "color-darker-grey"),
                El(equals=(("data-test", "product-name"),)), _cls(None, "product-name"),
            ),
            "words", rule="non_empty",
        ),
        Take(
            "visit_href",
            (
                El(equals=(("data-test", "visit-website-button"),)),
                El("a", contains=(("href", "ref=producthunt"),)),
                El("a", text="Visit website"),
                _cls(None, "visit-website"),
                El("a", equals=(("target", "_blank"),), text="Visit"),
            ),
            "href", rule="non_empty",
        ),
        Take(
            "additional_url",
            (
                El("span", contains=_LINE_CLASSES),
                _cls("span", "max-w-[260px]", "truncate", "font-semibold"),
                El("span", equals=(("class", "max-w-[260px] truncate font-semibold"),)),
                _cls("span", "font-semibold", "truncate"),
            ),
            "words", rule="url",
        ),
    ),
)
TOOL_NAME_PAGE = RecordSpec(
    fields=(
        Take("page_title", (El("title"),), "words"),
        Take(
            "tool_name",
            (
                El("h1", equals=(("data-sentry-component", "LegacyText"),)),
                _cls("h1", "text-16", "font-normal", "text-dark-gray", "text-24", "font-semibold", "text-gray-900"),
            ),
            "words", default=lx.NOT_AVAILABLE,
        ),
    ),
)

# --- fixed values: review list -------------------------------------------------------------
_GREY = ("color-lighter-grey", "fontSize-14", "fontWeight-400")
_USER = _cls("a", "color-darker-grey", "fontSize-16", "fontWeight-600")


def _page(name: str, el: El, value: str = "words") -> Take:
    return Take(name, (el,), value, default=lx.NOT_AVAILABLE, page_level=True)


def _review(name: str, el: El, value: str = "words") -> Take:
    return Take(name, (el,), value, default=lx.NOT_AVAILABLE)


REVIEWS = RecordSpec(
    containers=(El("div", starts=(("id", "review-"),)),),
    fields=(
        _page("tool_name", _cls("h1", "color-darker-grey")),
        _page("tool_link", _cls("a", "styles_format__k3_8m"), "href"),
        _page("all_time_score", _cls("div", "styles_reviewPositive__JY_9N")),
        _page("recent_review_score", _cls("div", "styles_recentReviewRating__n9hRY")),
        _page("recent_reviews_text", _cls("span", *_GREY, under=_cls("div", "flex", "direction-row"))),
        Take("review_id", (), "id"),
        _review("review_text", _cls("div", "styles_htmlText__iftLe")),
        _review("user_name", _USER),
        _review("user_href", _USER, "href"),
        _review("helpful_text", _cls("div", "color-lighter-grey", "fontSize-12", "fontWeight-600")),
        _review("review_date", El("time"), "datetime"),
    ),
)

# --- fixed values: profile cards -----------------------------------------------------------
_NAME = (_cls("h3", "gs_ai_name"), El("h3"), El("a"))
PROFILES = RecordSpec(
    containers=(
        _cls("div", "gsc_1usr"),
        El("div", contains=(("class", "gsc_1usr"),)),
        El("div", contains=(("class", "gs_ai"),)),
        _cls(None, "gs_ai_t"),
        El("div", contains=(("class", "scholar"),)),
    ),
    fields=(
        Take("name", _NAME, "pieces", default=lx.NOT_AVAILABLE),
        Take("profile_url", _NAME, "href", default=lx.NOT_AVAILABLE, then=El("a"), prefix=lx.PROFILE_HOST, filled=True),
        Take("affiliation", (_cls("div", "gs_ai_aff"), El("div", single_text=True)), "pieces", default=lx.NOT_AVAILABLE),
        Take("email", (_cls("div", "gs_ai_eml"),), "pieces", default=lx.NOT_AVAILABLE),
        Take("citations", (_cls("div", "gs_ai_cby"),), "pieces", default=lx.NOT_AVAILABLE),
        Take(
            "research_interests", (_cls("div", "gs_ai_int"),), "pieces", default=lx.NOT_AVAILABLE,
            then=_cls("a", "gs_ai_one_int"), many=", ",
        ),
        Take("image_url", (El("img"),), "src", default=lx.NOT_AVAILABLE, filled=True),
    ),
)
_LINKED = El("a", inside=_cls(None, "gs_ai_name"))
PROFILES_LABELLED = RecordSpec(
    containers=(_cls(None, "gsc_1usr"),),
    fields=(
        Take("name", (_LINKED,), "words", default=lx.NOT_AVAILABLE),
        Take("profile_url", (_LINKED,), "href", default=lx.NOT_AVAILABLE),
        Take("affiliation", (_cls(None, "gs_ai_aff"),), "words", default=lx.NOT_AVAILABLE),
        Take("email", (_cls(None, "gs_ai_eml"),), "words", default=lx.NOT_AVAILABLE),
        Take("citations", (_cls(None, "gs_ai_cby"),), "words", default=lx.NOT_AVAILABLE),
        Take(
            "interests", (_cls(None, "gs_ai_int"),), "words", default="",
            then=_cls(None, "gs_ai_one_int"), many="; ",
        ),
        Take("profile_picture_url", (El("img"),), "src", default=lx.NOT_AVAILABLE),
        Take("profile_picture_alt", (El("img"),), "alt", default=lx.NOT_AVAILABLE),
    ),
)
