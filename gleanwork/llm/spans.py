"""Positions of pattern matches in code points, with SQL functions only."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of context kept before a match.
CONTEXT = 24
#: Numbers added up in one go, see `sums_before`.
RUN = 64


def with_matches(df: DataFrame, text: str, patterns: dict[str, str], needs: dict[str, str] | None = None) -> DataFrame:
    """Per name an array<struct<start, end, hit, before, after>> of the leftmost matches of its
    pattern that do not overlap; end exclusive; null text as empty. Patterns never match nothing.

    A pattern is tried on texts that hold what it `needs`, a cheaper pattern found within each of its matches. Where it has
    matches, the text between them is split off, and running lengths give the positions. The work grows with the matches.
    """
    body, needs = F.coalesce(F.col(text), F.lit("")), needs or {}
    none = F.array().cast("array<string>")
    hits, gaps = {}, {}
    for name, pattern in patterns.items():
        found = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
        hits[f"__hits_{name}"] = F.when(body.rlike(needs[name]), found).otherwise(none) if name in needs else found
        gaps[f"__gaps_{name}"] = F.when(F.size(f"__hits_{name}") > 0, F.split(body, pattern, -1)).otherwise(none)
    df = df.withColumns(hits).withColumns(gaps)
    return df.withColumns({n: _placed(F.col(f"__hits_{n}"), F.col(f"__gaps_{n}")) for n in patterns}).drop(*hits, *gaps)


def _placed(hits: Column, gaps: Column) -> Column:
    def whole(x: Column) -> Column:
        def one(hit: Column, i: Column) -> Column:
            start = F.get(x["at"], i) + F.length(F.get(x["gaps"], i))
            return F.struct(
                start.alias("start"), (start + F.length(hit)).alias("end"), hit.alias("hit"),
                F.right(F.get(x["gaps"], i), F.lit(CONTEXT)).alias("before"), F.left(F.get(x["gaps"], i + 1), F.lit(1)).alias("after"))
        return F.transform(x["hits"], one)

    lengths = F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda hit, gap: F.length(hit) + F.length(gap))
    placed = bound(F.struct(hits.alias("hits"), gaps.alias("gaps"), sums_before(lengths).alias("at")), whole)
    kind = "array<struct<start:int,end:int,hit:string,before:string,after:string>>"
    return F.when(F.size(hits) > 0, placed).otherwise(F.array()).cast(kind)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def sums_before(numbers: Column, levels: int = 3) -> Column:
    """For every whole number of an array the sum of those before it.

    An aggregate copies its array at every step, so arrays are cut into runs of `RUN`, whose sums are
    added up in the same way, `levels` deep.
    """
    empty = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))

    def flat(x: Column) -> Column:
        return F.aggregate(x, empty, lambda acc, n: F.struct((acc["sum"] + n).alias("sum"), F.concat(acc["out"], F.array(acc["sum"])).alias("out")))

    def of_runs(x: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / RUN).cast("int"))
        return F.transform(starts, lambda r: flat(F.slice(x, r * RUN + 1, F.lit(RUN))))

    def shifted(runs: Column) -> Column:
        before = sums_before(F.transform(runs, lambda r: r["sum"]), levels - 1)
        return F.flatten(F.zip_with(runs, before, lambda r, n: F.transform(r["out"], lambda own: own + n)))

    if levels == 1:
        return flat(numbers)["out"]
    return bound(numbers, lambda x: F.when(F.size(x) <= RUN, flat(x)["out"]).otherwise(bound(of_runs(x), shifted)))


def count_upto(ordered: Column, limit: Column) -> Column:
    """How many numbers of an ascending array are at most `limit`, by halving."""
    step = lambda acc, _: bound(F.floor((acc["low"] + acc["high"]) / 2).cast("int"), lambda mid: F.when(
        acc["low"] >= acc["high"], acc).when(F.get(ordered, mid) <= limit, F.struct((mid + 1).alias("low"), acc["high"].alias("high")))
        .otherwise(F.struct(acc["low"].alias("low"), mid.alias("high"))))
    start = F.struct(F.lit(0).alias("low"), F.size(ordered).alias("high"))
    rounds = F.sequence(F.lit(1), F.length(F.bin(F.size(ordered))))
    return F.aggregate(rounds, start, step, lambda acc: acc["low"])


def edges(spans: Column) -> Column:
    """The starts and the ends of spans, each ascending."""
    return F.struct(
        F.array_sort(F.transform(spans, lambda s: s["start"])).alias("starts"), F.array_sort(F.transform(spans, lambda s: s["end"])).alias("ends"))


def meets(s: Column, others: Column) -> Column:
    """Whether a span overlaps one of those with the `edges` others: more start before its end than end by its start."""
    return count_upto(others["starts"], s["end"] - 1) > count_upto(others["ends"], s["start"])


def tagged(matches: Column, kind: str, place: int) -> Column:
    """array<struct<start, place, end, kind>>, which sorts by start, then by kind as listed."""
    return F.transform(matches, lambda m: F.struct(
        m["start"].alias("start"), F.lit(place).alias("place"), m["end"].alias("end"), F.lit(kind).alias("kind")))


def all_of(arrays: Sequence[Column]) -> Column:
    return F.array_sort(F.concat(*arrays))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def outside(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others."""
    return bound(edges(others), lambda e: F.filter(spans, lambda s: ~meets(s, e)))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Of a string of digits: from the right every second digit doubled, the digits' sum divisible by 10."""
    figures = F.transform(F.split(F.reverse(number), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    doubled = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
