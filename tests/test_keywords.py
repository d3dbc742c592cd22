"""Long keyword lists against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gleanwork.functions import predicates
from gleanwork.operators import keywords


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def pairs(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    alphabet = "abcdé fgß."
    made = ["".join(rng.choice(alphabet) for _ in range(rng.choice((0, 3, 40, 400)))) for _ in range(120)]
    return [*enumerate([*made, None, "", "ABBA Straße İstanbul ſoft ΣΑΣ", "x" * 300000 + "needle"]), (3, made[3]), (None, made[5])]


@pytest.mark.parametrize("block_chars", [10**6, 700])
@pytest.mark.parametrize("case_sensitive", [False, True])
def test_substrings(spark, texts, block_chars, case_sensitive):
    rng = random.Random(2)
    terms = {"", "abba", "ABBA", "needle", "x" * 50, "ß", "missing", "İs"}
    for _ in range(400):
        text = rng.choice(texts)[1] or "q"
        at = rng.randrange(len(text) or 1)
        terms.add(text[at:at + rng.choice((1, 2, 5, 30))])
    listed = frame(spark, [(t,) for t in terms] + [(None,), ("abba",)], "t STRING")
    docs = frame(spark, texts, "id INT, b STRING")
    got = keywords.match_substrings(docs, "id", "b", listed, "t", case_sensitive, block_chars)
    own = (lambda s: s) if case_sensitive else str.lower
    want = [(i, t) for i, b in texts if b is not None for t in terms if own(t) in own(b)]
    assert pairs(got) == sorted(want, key=repr)
    some = sorted(terms)[:30]
    kept = docs.filter("id IS NOT NULL").filter(predicates.any_keyword(F.col("b"), some, case_sensitive))
    few = keywords.match_substrings(docs, "id", "b", frame(spark, [(t,) for t in some], "t STRING"), "t", case_sensitive)
    assert pairs(keywords.with_any(docs.filter("id IS NOT NULL"), "id", few)) == pairs(kept)


def test_a_hundred_thousand_substrings(spark):
    rng = random.Random(3)
    docs = [(i, "".join(rng.choice("abcdefgh") for _ in range(2000))) for i in range(300)]
    terms = {"".join(rng.choice("abcdefgh") for _ in range(rng.choice((6, 7)))) for _ in range(130000)}
    assert len(terms) > 100000
    got = keywords.match_substrings(frame(spark, docs, "id INT, b STRING"), "id", "b", spark.createDataFrame([(t,) for t in terms], "term STRING"))
    want = {(i, b[k:k + n]) for i, b in docs for n in (6, 7) for k in range(len(b) - n + 1)}
    want = {(i, t) for i, t in want if t in terms}
    found = got.toArrow()
    assert len(found) == len(want) and set(zip(found["id"].to_pylist(), found["term"].to_pylist())) == want


def test_empty_lists_and_tables(spark):
    docs, none = frame(spark, [(1, "a")], "id INT, b STRING"), frame(spark, [], "id INT, b STRING")
    no_terms = frame(spark, [], "term STRING")
    for match, column in ((keywords.match_substrings, "term"), (keywords.match_patterns, "pattern")):
        listed = no_terms.withColumnRenamed("term", column)
        assert match(docs, "id", "b", listed).count() == 0
        assert match(none, "id", "b", frame(spark, [("a",)], f"{column} STRING")).count() == 0
        assert match(docs, "id", "b", listed).schema.names == ["id", column]


PATTERNS = ["risk", "e.n", "colou?r", "ab+c", "(foo|bar)baz", "foo|bar", "x", "a{2,3}b", r"v\d+\.\d+", r"c\+\+", "[aeiou]{3}", r"\bword\b", "(?i:q)uick", "(?x) a b",
            "straße", "soft", "kelvin", "is", r"\Qa.b\E", "fo(o", "end$", "^start", "(?<n>ab)cd", "a]b", "λόγος", "", "go (now|then)? please", r"(a)\1", "[[a]b]c", "x*yz+?w", "ΣΑΣ"]


def test_required_texts():
    got = {p: keywords.required_texts(p) for p in PATTERNS}
    assert got["risk"] == ["risk"] and got["e.n"] is None and got["colou?r"] == ["colo"] and got["ab+c"] == ["ab"] and got["(foo|bar)baz"] == ["baz"]
    assert got["foo|bar"] == ["foo", "bar"] and got["x"] is None and got["a{2,3}b"] is None and got[r"c\+\+"] == ["c++"] and got["go (now|then)? please"] == [" please"]
    assert got["(?<n>ab)cd"] == ["cd"] and got["x*yz+?w"] == ["yz"]
    assert all(got[p] is None for p in (r"\Qa.b\E", "(?x) a b", "(?i:q)uick", "fo(o", "a]b", "", r"(a)\1", "[[a]b]c"))


@pytest.mark.parametrize("block_chars", [10**6, 30])
@pytest.mark.parametrize("whole_word", [True, False])
def test_patterns(spark, block_chars, whole_word):
    valid = [p for p in PATTERNS if p not in ("fo(o",)]
    rng = random.Random(4)
    words = ["Risk", "even", "color", "COLOUR", "abbbc", "foobaz", "barbaz", "foo", "aab", "v1.25", "C++", "queue", "word", "quick", "STRASSE", "straße", "ſoft", "Kelvin", "İs", "is",
             "a.b", "end", "start", "abcd", "a]b", "ΛΌΓΟΣ", "λόγος", "go now please", "go  please", "aa", "bc", "yzzw", "xxyzw", "ΣΑΣ", "σας", "x"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.choice((0, 1, 3))))) for i in range(150)] + [(900, None), (901, "start risk"), (902, "the end")]
    df = frame(spark, docs, "id INT, b STRING")
    got = keywords.match_patterns(df, "id", "b", frame(spark, [(p,) for p in [*valid, None]], "pattern STRING"), whole_word=whole_word, block_chars=block_chars)
    want = []
    for p in valid:
        test = predicates.any_word(F.col("b"), [p]) if whole_word else F.rlike("b", F.lit(f"(?iu)(?:{p})"))
        want += [(r.id, p) for r in df.filter(test).collect()]
    assert pairs(got) == sorted(want, key=repr)


def test_patterns_reach_the_text_only_where_they_may_match(spark):
    """The plan moves no text, and a list of thousands is as cheap as its hits."""
    listed = spark.range(20000).select(F.concat(F.lit("item"), F.col("id"), F.lit("[a-z]?")).alias("pattern"))
    docs = spark.range(2000).select("id", F.concat(F.lit("see item"), F.col("id") * 7, F.lit("b, or not")).alias("b"))
    got = keywords.match_patterns(docs, "id", "b", listed)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert {(r.id, r.pattern) for r in got.collect()} == {(i, f"item{7 * i}[a-z]?") for i in range(2000)}
    assert re.fullmatch("item0.*", min(r.pattern for r in got.collect()))


def test_leading_texts_are_tried_where_words_begin(spark):
    """Patterns are left to Spark only for texts in which a word begins as they do and, in ASCII texts, goes on as they do."""
    texts = ["overrisk", "a risky", "risk-x", "over_risk", "ürisk", "ȧrisk", "ͅrisk", "RISKs", None, ""]
    some = keywords._pattern_finder(spark.range(1), ["risk"], ["risk[a-r]?"], [True], [])
    level = lambda t: keywords._SAME if t is None or t.isascii() else keywords._ANY if "̇" in t else keywords._BOUNDED
    df = frame(spark, [(i, t, level(t)) for i, t in enumerate(texts)], "id INT, b STRING, known INT")
    got = {texts[r.id]: r.found for r in df.select("id", some(keywords.folded(F.col("b")), F.col("known")).alias("found")).collect()}
    assert {t for t, found in got.items() if found} == {"risk-x", "ürisk", "ȧrisk", "ͅrisk"}
    listed = frame(spark, [("risk[a-r]?",), ("ver.?risk|risk",), ("ri.ks",), ("over(_|)risk",)], "pattern STRING")
    want = [(r.id, p) for (p,) in listed.collect() for r in df.filter(predicates.any_word(F.col("b"), [p])).collect()]
    assert pairs(keywords.match_patterns(df, "id", "b", listed)) == sorted(want, key=repr)
