"""Keyword matching against lists too long for one expression.

Whole words and phrases (`match_terms`) need joins only. Substrings (`match_substrings`) and patterns
(`match_patterns`) are found by one automaton for the whole list, which reads a text once however long the list is. The list goes to the
executors in blocks of at most about `BLOCK_CHARS` characters; a longer list takes a further pass over the texts for each block, so
neither the driver nor a worker holds more than a block. Texts are never shuffled.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.predicates import WORD_END, WORD_START
from gleanwork.operators.joins import members

#: About 100 bytes of an automaton for each character, at the most.
BLOCK_CHARS = 2_000_000

# Anything but letters, numbers and underscore separates words.
SPLIT = r"[^\p{L}\p{N}_]+"


def _words(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), SPLIT), lambda w: w != "")


def match_terms(df: DataFrame, key: str, text: str, terms: DataFrame, term: str = "term") -> DataFrame:
    """(key, term) for every term that occurs as a whole word or phrase, ignoring case.

    The same answer as `predicates.any_word` with escaped keywords, for any number of terms. The
    distinct words of each text, one row each, join the distinct words of the terms, so the work is
    linear in the texts. Terms of one plain word are settled by that. For the others the words a
    text shares with a term are counted, and only the texts that hold all of them are tested.
    Terms without a single word character are not matched. Keys are unique.

    A word that stands in most texts is split by Spark as a skewed join: both sides come straight
    from their exchange.
    """
    listed = terms.select(F.col(term).alias("term")).distinct().select("term", F.array_distinct(_words(F.col("term"))).alias("__t"))
    wanted = listed.select("term", F.size("__t").alias("__n"), F.explode("__t").alias("__word"))
    words = df.select(key, F.explode(F.array_distinct(_words(F.col(text)))).alias("__word"))
    hits = words.join(wanted, "__word")
    plain = F.lower("term") == F.col("__word")
    single = hits.filter(plain).select(key, "term")
    held = hits.filter(~plain).groupBy(key, "term").agg(F.count("*").alias("__held"), F.first("__n").alias("__n"))
    possible = held.filter(F.col("__held") >= F.col("__n")).select(key, "term")
    quoted = F.concat(F.lit(r"\Q"), F.replace("term", F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    pattern = F.concat(F.lit("(?iu)" + WORD_START), quoted, F.lit(WORD_END))
    phrases = possible.join(df.select(key, text), key).filter(F.rlike(F.col(text), pattern)).select(key, "term")
    return single.unionByName(phrases)


def folded(c: Column) -> Column:
    """Lower case in which all characters that a pattern takes for one, ignoring case, look alike."""
    # The inner translation also keeps the optimizer from dropping the upper case.
    return F.translate(F.lower(F.translate(F.upper(c), "\u0307", "")), "ς\u0307", "σ")


#: The automaton a worker process used last, by the name of its list.
_LAST: dict[str, ahocorasick.Automaton] = {}


def _automaton(name: str, words: Callable[[], Iterator[tuple[str, list[str]]]]) -> ahocorasick.Automaton:
    if name not in _LAST:
        _LAST.clear()
        built = ahocorasick.Automaton()
        for word, found in words():
            if built.exists(word):
                built.get(word).extend(found)
            else:
                built.add_word(word, found)
        if len(built):
            built.make_automaton()
        _LAST[name] = built
    return _LAST[name]


def _finder(df: DataFrame, words: list[str], found: list[str], always: list[str]) -> Callable[[Column], Column]:
    """array<string> of what is found in a text: found[i] if it holds words[i], and `always` in any text."""
    sent = df.sparkSession.sparkContext.broadcast((words, found, always))
    name = uuid.uuid4().hex

    @F.arrow_udf("array<string>")
    def find(texts: pa.Array) -> pa.Array:
        words, found, always = sent.value
        automaton = _automaton(name, lambda: ((w, [f]) for w, f in zip(words, found)))
        out: list[list[str] | None] = []
        for text in texts.to_pylist():
            if text is None:
                out.append(None)
                continue
            hits = {id(x): x for _, x in automaton.iter(text)} if len(automaton) else {}
            out.append(sorted({f for x in hits.values() for f in x}.union(always)))
        return pa.array(out, pa.list_(pa.string()))

    return find


def _blocks(listed: DataFrame, column: str, size: int) -> Iterator[pa.Table]:
    """The rows of a list in blocks of about `size` characters of a column."""
    total = listed.agg(F.sum(F.length(column) + 1).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(total / size))
    for b in range(blocks):
        yield listed.filter(F.pmod(F.xxhash64(column), F.lit(blocks)) == b).toArrow()


def _united(parts: Sequence[DataFrame], empty: DataFrame) -> DataFrame:
    out = empty
    for i, part in enumerate(parts):
        out = part if i == 0 else out.unionByName(part)
    return out


def match_substrings(
    df: DataFrame, key: str, text: str, terms: DataFrame, term: str = "term", case_sensitive: bool = False, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(key, term) for every distinct term that is a substring of the text.

    The same answer as `predicates.any_keyword`, for any number of terms. A missing text holds nothing, a missing term is
    left out, the empty term is in every text. Terms that differ in case only are reported each. Rows with one key are reported each.
    """
    own = (lambda c: c) if case_sensitive else F.lower
    listed = terms.select(F.col(term).cast("string").alias("term")).filter(F.col("term").isNotNull()).distinct().select("term", own(F.col("term")).alias("word"))
    parts = []
    for block in _blocks(listed, "word", block_chars):
        rows = list(zip(block["word"].to_pylist(), block["term"].to_pylist()))
        if rows:
            some = [(w, t) for w, t in rows if w]
            find = _finder(df, [w for w, _ in some], [t for _, t in some], [t for w, t in rows if not w])
            parts.append(df.select(key, F.explode(find(own(F.col(text).cast("string")))).alias("term")))
    return _united(parts, df.select(key, F.lit("").alias("term")).filter(F.lit(False)))


_TOKEN = re.compile(
    r"(?P<text>[^\\\[\](){}.^$|?*+]|\\[^a-zA-Z0-9])|(?P<other>\\[dDwWsSbBAzZGtnrfvhHRX]|\\[pP](?:\w|\{\w+\})|\[\^?(?:\\.|[^\[\]\\])+\]|[.^$])"
    r"|(?P<more>\+[?+]?)|(?P<maybe>[?*][?+]?|\{\d+,?\d*\}[?+]?)|(?P<bar>\|)|(?P<open>\((?:\?(?:[:=!>]|<[=!]|<\w+>)|(?!\?)))|(?P<close>\))", re.DOTALL)


def _required(pattern: str) -> list[tuple[str, bool]] | None:
    """`required_texts`, each with whether a match by its alternative begins with it."""
    longest = lambda runs: (max(runs, key=len), len(runs[0]) == max(map(len, runs)))
    needed: list[tuple[str, bool]] = []
    runs, at, depth = [""], 0, 0
    while at < len(pattern):
        token = _TOKEN.match(pattern, at)
        if not token:
            return None
        kind, found, at = token.lastgroup, token[0], token.end()
        depth += {"open": 1, "close": -1}.get(kind, 0)
        if depth < 0:
            return None
        if depth or kind == "close":
            if kind == "open":
                runs.append("")
        elif kind == "text":
            runs[-1] += found[-1]
        elif kind == "bar":
            needed.append(longest(runs))
            runs = [""]
        else:
            if kind == "maybe":
                runs[-1] = runs[-1][:-1]
            runs.append("")
    needed.append(longest(runs))
    return needed if not depth and min(len(text) for text, _ in needed) >= 2 else None


def required_texts(pattern: str) -> list[str] | None:
    """Literal texts of which any match of the pattern holds at least one, ignoring case; None if there may be none.

    One for each alternative: its longest run of plain characters outside groups and classes. Patterns with flags of their own, quotations,
    back references or nested classes are not read, nor those with an alternative without a run of two.
    """
    needed = _required(pattern)
    return None if needed is None else [text for text, _ in needed]


# What Java and Python read alike: plain characters, `.`, plain classes, groups, alternatives and quantifiers that may give back.
_SHARED = re.compile(
    r"(?:[a-zA-Z0-9 _]|\\[.+*?()\[\]{}|^$/\\-]|\.|\[(?:[a-z]-[a-z]|[A-Z]-[A-Z]|[0-9]-[0-9]|[a-zA-Z0-9_ ])+\]|\((?:\?:)?|[)|]|(?:[+*?]|\{\d+(?:,\d*)?\})\??(?![+*?{]))+")
_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789_")


def _test_of(pattern: str) -> re.Pattern | None:
    """For ASCII texts in lower case: matches where the pattern matches a whole word, and perhaps elsewhere. None for patterns that may be read in
    two ways."""
    try:
        return re.compile(f"(?:{pattern})(?![a-z0-9_])", re.IGNORECASE | re.DOTALL) if _SHARED.fullmatch(pattern) else None
    except re.error:
        return None


#: How much of a folded text is known to stand as in the text: not where words begin, that, or every character.
_ANY, _BOUNDED, _SAME = 0, 1, 2


def _pattern_finder(df: DataFrame, words: list[str], found: list[str], leading: list[bool], always: list[str]) -> Callable[[Column, Column], Column]:
    """array<string> of the patterns that a text may match: found[i] if it holds words[i], and `always`. A leading word must begin where a
    word of the text begins, and in ASCII texts the pattern must match from there."""
    sent = df.sparkSession.sparkContext.broadcast((words, found, leading, always))
    name = uuid.uuid4().hex

    @F.arrow_udf("array<string>")
    def find(texts: pa.Array, known: pa.Array) -> pa.Array:
        words, found, leading, always = sent.value
        tests = {p: _test_of(p) for p in set(found)}
        automaton = _automaton(name, lambda: ((w, [(f, lead)]) for w, f, lead in zip(words, found, leading)))
        sizes = {id(automaton.get(w)): len(w) for w in words}
        out: list[list[str] | None] = []
        for text, level in zip(texts.to_pylist(), known.to_pylist()):
            if text is None:
                out.append(None)
                continue
            hits = set(always)
            for end, candidates in automaton.iter(text) if len(automaton) else ():
                start = end + 1 - sizes[id(candidates)]
                within = level != _ANY and start > 0 and text[start - 1] in _WORD
                for pattern, lead in candidates:
                    if pattern in hits or (lead and within):
                        continue
                    test = tests[pattern] if lead and level == _SAME else None
                    if test is None or test.match(text, start):
                        hits.add(pattern)
            out.append(sorted(hits))
        return pa.array(out, pa.list_(pa.string()))

    return find


def match_patterns(
    df: DataFrame, key: str, text: str, patterns: DataFrame, pattern: str = "pattern", whole_word: bool = True, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(key, pattern) for every distinct pattern that matches the text, ignoring case; as whole words by default.

    The same answer as `predicates.any_word` for each pattern, for any number of patterns. One automaton of the texts that the patterns
    require finds the patterns that a text may match, and only those are tried by Spark. A whole word that begins with its required text is
    looked for at the beginnings of words only, and in ASCII texts it is tried there before. Patterns that require no text of two characters are tried on every
    text, so their number is what costs. A missing text matches nothing; a missing pattern is left out; an invalid one is an error.
    """
    listed = patterns.select(F.col(pattern).cast("string").alias("pattern")).filter(F.col("pattern").isNotNull()).distinct()
    parts = []
    for block in _blocks(listed, "pattern", block_chars):
        given = block["pattern"].to_pylist()
        needs = {p: _required(p) for p in given}
        asked = [(t, p, lead and whole_word) for p, texts in needs.items() for t, lead in texts or ()]
        if not given:
            continue
        # Folded by Spark, as the texts are.
        kinds = (("t", pa.string()), ("p", pa.string()), ("lead", pa.bool_()))
        rows = df.sparkSession.createDataFrame(pa.table({name: pa.array([a[i] for a in asked], kind) for i, (name, kind) in enumerate(kinds)}))
        words = rows.select(folded(F.col("t")).alias("t"), "p", "lead").toArrow()
        find = _pattern_finder(df, *[words[name].to_pylist() for name, _ in kinds], [p for p, texts in needs.items() if not texts])
        whole = F.col(text).cast("string")
        # Folding takes the dot above away, which separates words; of ASCII texts it leaves the lower case.
        ascii_only = F.octet_length(whole) == F.length(whole)
        known = F.when(ascii_only, _SAME).when(F.contains(whole, F.lit("\u0307")), _ANY).otherwise(_BOUNDED)
        some = find(F.when(ascii_only, F.lower(whole)).otherwise(folded(whole)), known)
        # One row for each pattern to be tried: in a function over the array Spark would try them three times.
        tried = df.select(key, whole.alias("__text"), some.alias("__some")).select(key, "__text", F.explode("__some").alias("__pattern"))
        start, end = (WORD_START, WORD_END) if whole_word else ("", "")
        right = F.rlike(F.col("__text"), F.concat(F.lit(f"(?iu){start}(?:"), F.col("__pattern"), F.lit(f"){end}")))
        parts.append(tried.filter(right).select(key, F.col("__pattern").alias("pattern")))
    return _united(parts, df.select(key, F.lit("").alias("pattern")).filter(F.lit(False)))


def with_any(df: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """The rows with a hit among (key, ...) pairs: the filter for lists of any length."""
    return members(df, found, key)
