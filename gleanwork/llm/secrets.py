"""Secrets in texts: strong ones by pattern, weak parts only where they complete a credential.

Strong: assignments to a secret's name, access keys, long hex runs. Weak: account names, opaque
mixed strings and endpoints with a scheme. Every part, strong or weak, is posted to the scopes (bins of
`SCOPE` characters) its interval reaches, and an interval join within row and scope finds the parts at most
`SCOPE` characters apart. An account name is reported if a secret is near; an opaque string if an account, an
access key or an endpoint is; an endpoint if both an account and a secret are. A scope holds a
bounded number of parts (they do not overlap within a kind), so hot documents make no hot group.

Null texts are empty. Rows are told apart by a row number, so equal ids and rows do not mix. Weak parts
that overlap a strong span are left out. Empty table: empty result. Columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.llm.names import quoted
from gleanwork.llm.spans import all_of, outside, tagged, with_matches
from gleanwork.session import staged

ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
STRONG = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}
WEAK = {
    "account": "(?i)(?<![a-z0-9])(?:user(?:name)?|login|account|client_id|access_key(?:_id)?)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9@._-]{3,}",
    "opaque": "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}",
    "endpoint": "(?i)(?<![a-z])(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\\x00-\\x20\"'<>]+",
}
KINDS = [*STRONG, *WEAK]
LEAST_VALUE = 6
SCOPE = 200
#: Which parts complete a weak one: all of these sets must have a member near.
NEEDS = {
    "account": (("assign", "hex", "opaque"),),
    "opaque": (("access", "account", "endpoint"),),
    "endpoint": (("access", "account"), ("assign", "hex", "opaque")),
}
RESULT = ("base", "spans")


def _mixed(c: Column) -> Column:
    """Lower and upper case and a digit: words, paths and numbers lack one."""
    return c.rlike("[a-z]") & c.rlike("[A-Z]") & c.rlike("[0-9]")


def _parts(docs: DataFrame, keep: Sequence[str], text: str) -> DataFrame:
    found = with_matches(docs.select(*[quoted(c).alias(f"keep_{i}") for i, c in enumerate(keep)], F.col(text).alias("text")), "text", STRONG | WEAK)
    found = found.withColumns({
        "assign": F.filter("assign", lambda m: F.length(F.regexp_extract(m["hit"], ASSIGN, 2)) >= LEAST_VALUE),
        "opaque": F.filter("opaque", lambda m: _mixed(m["hit"])),
    })
    found = found.select(
        F.monotonically_increasing_id().alias("row"), *[f"keep_{i}" for i in range(len(keep))],
        all_of([tagged(F.col(k), k, KINDS.index(k)) for k in STRONG]).alias("base"),
        all_of([tagged(F.col(k), k, KINDS.index(k)) for k in WEAK]).alias("weak"))
    return staged(found.withColumn("weak", outside(F.col("weak"), F.col("base"))), "secret-parts")


def _completed(parts: DataFrame) -> DataFrame:
    """(row, weak): the weak parts that others complete."""
    scope = lambda c: F.floor(c / F.lit(SCOPE))
    offers = parts.filter(F.size("weak") > 0).select("row", F.explode(F.concat("base", "weak")).alias("o"))
    offers = offers.select("row", "o", F.explode(F.sequence(scope(F.col("o.start") - SCOPE), scope(F.col("o.end") + SCOPE))).alias("scope"))
    weak = parts.select("row", F.explode("weak").alias("w")).withColumn("scope", scope(F.col("w.start")))
    near = weak.join(offers, ["row", "scope"]).filter(
        (F.col("o.start") <= F.col("w.end") + SCOPE) & (F.col("o.end") + SCOPE >= F.col("w.start")) & (F.col("o") != F.col("w")))
    kinds = near.groupBy("row", "w").agg(F.collect_set("o.kind").alias("kinds"))
    complete = F.lit(False)
    for kind, needs in NEEDS.items():
        met = F.lit(True)
        for group in needs:
            met = met & F.arrays_overlap("kinds", F.array(*[F.lit(k) for k in group]))
        complete = complete | ((F.col("w.kind") == kind) & met)
    return kinds.filter(complete).groupBy("row").agg(F.collect_list("w").alias("added"))


def find_secrets(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """The columns `keep` of every document with `base` and `spans`, arrays of (start, place, end,
    kind) in code points, end exclusive, sorted by start and then kind."""
    keep = [c for c in keep if c not in RESULT]
    parts = _parts(docs, keep, text)
    out = parts.join(_completed(parts), "row", "left")
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))
    return out.select(*[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "base", spans.alias("spans"))
