"""Mix sources to target weights: whole copies, then a Pareto sample of fixed size in words.

Sources in code-point order (null last) get the weights in turn. Targets share all words by weight
and stop at `MAX_COPIES` times the source's words; what is over goes to the others by weight.

A source whose target is r times its words gets floor(r) copies of every document. The rest
f = r - floor(r) is an unequal-probability sample: a document is included with probability
f + f (1 - f) t, where t in [-1, 1] grows with its length and averages 0 over the source's words, so
that the expected words are f times the source's. Documents are ranked by u / (1 - u) divided by
p / (1 - p), u a hash of id and text, and taken in that order up to the prefix whose words come nearest to what is
left (the shorter one on a tie). Ranks are cut into 2^10 bins of 2^10 bins, whose words are added up
before any shuffle; only the documents in the one bin where a source's prefix ends are sorted.

Null text: 0 words. Null ids and sources: a null source is a source of its own; ids only seed the
hash. Equal rows get equal hashes and are all taken or all left. Empty table: empty result. A source
without words has target and taken 0. Columns named like a result are replaced by it. Targets are
found by windows over one row per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanwork.session import staged

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
#: Words at which a document's length preference is half its largest.
HALF_LENGTH = 500
RESULT = ("size", "source_size", "target", "taken")
_RANK_BITS, _BIN_BITS = 50, 10
_WORD = "[^\\x20\\x09-\\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def measured(docs: DataFrame, key: str, source: str, text: str, seed: int) -> DataFrame:
    """The documents with `__source`, `__size`, the length preference in thousandths and `__u`."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit("")))))
    return docs.withColumns({"__source": F.col(source), "__size": n_words(F.col(text)), "__bits": F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")}).withColumns({
        "__liking": F.expr(f"__size * 1000 div (__size + {HALF_LENGTH})"),
        "__u": (F.col("__bits") + 0.5) / F.lit(float(1 << 52)),
    }).drop("__bits")


def targets(rows: DataFrame, weights: Sequence[int], max_copies: int) -> DataFrame:
    """One row per source: its words, its target, copies for all and what is left to sample."""
    per = rows.groupBy("__source").agg(
        F.sum("__size").alias("source_size"),
        F.try_divide(F.sum(F.col("__size") * F.col("__liking")), F.sum("__size") * 1000.0).alias("mean_liking"),
    )
    place = F.row_number().over(Window.orderBy(F.col("__source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int"))
    limit = F.col("source_size") * float(max_copies)
    per = per.withColumn("weight", weight).withColumns({"limit": limit, "at": limit / F.col("weight")})
    order = Window.orderBy("at", F.col("__source").asc_nulls_last())
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    per = per.withColumn("level", level)
    # Sources below their limit share one level: the first that does not exceed the limit it meets.
    level = F.first(F.when(F.col("level") <= F.col("at"), F.col("level")), ignorenulls=True).over(whole)
    per = per.withColumn("target", F.least("limit", F.col("weight") * level))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    per = per.withColumn("rate", rate).withColumn("copies", F.floor("rate"))
    return per.select(
        "__source", "source_size", F.coalesce("mean_liking", F.lit(0.0)).alias("mean_liking"), "target", "copies",
        (F.col("rate") - F.col("copies")).alias("share"),
        (F.col("target") - F.col("copies") * F.col("source_size")).alias("left"),
    )


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Spark broadcasts the plan while it is small, and joins by shuffle beyond."""
    return rows.join(plan.withColumnRenamed("__source", "__of"), F.col("__source").eqNullSafe(F.col("__of")), "left").drop("__of")


def _rank() -> Column:
    """The Pareto rank, as a whole number that grows with it."""
    f, mean = F.col("share"), F.col("mean_liking")
    tilt = (F.col("__liking") / 1000.0 - mean) / F.greatest(mean, 1.0 - mean)
    p = f + f * (1.0 - f) * tilt
    q = (F.col("__u") / (1.0 - F.col("__u"))) * ((1.0 - p) / p)
    return F.when(f > 0, F.floor(q / (1.0 + q) * F.lit(float(1 << _RANK_BITS))).cast("long"))


def _narrowed(ranked: DataFrame, plan: DataFrame, depth: int) -> DataFrame:
    """The plan with the bin in which each source's prefix ends, and the words left within it."""
    shift = _RANK_BITS - _BIN_BITS * (depth + 1)
    inside = ranked if not depth else ranked.filter(F.shiftright("__rank", shift + _BIN_BITS) == F.col("bin"))
    bins = inside.groupBy("__source", F.shiftright("__rank", shift).alias("to_bin")).agg(
        F.sum("__size").alias("words"), F.first("left").alias("of_left"))
    upto = F.sum("words").over(Window.partitionBy("__source").orderBy("to_bin"))
    over = bins.withColumn("upto", upto).filter(F.col("upto") > F.col("of_left"))
    first = over.groupBy("__source").agg(F.min(F.struct("to_bin", (F.col("of_left") - F.col("upto") + F.col("words")).alias("rest"))).alias("__end"))
    joined = plan.drop("bin").join(first.withColumnRenamed("__source", "__of"), F.col("__source").eqNullSafe(F.col("__of")), "left").drop("__of")
    return staged(joined.select("*", F.col("__end.to_bin").alias("bin")).withColumn("left", F.coalesce("__end.rest", "left")).drop("__end"), "mix-plan")


def plan_of(rows: DataFrame, weights: Sequence[int] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per source: target, copies of every document, and the last rank to take once more."""
    plan = staged(targets(rows, weights, max_copies), "mix-plan")
    sampled = F.col("share") > 0
    for depth in (0, 1):
        ranked = _with_plan(rows, plan).filter(sampled).withColumn("__rank", _rank())
        plan = _narrowed(ranked, plan, depth)
    shift = _RANK_BITS - 2 * _BIN_BITS
    last = _with_plan(rows, plan).filter(sampled).withColumn("__rank", _rank()).filter(F.shiftright("__rank", shift) == F.col("bin"))
    upto = F.sum("__size").over(Window.partitionBy("__source").orderBy("__rank").rangeBetween(Window.unboundedPreceding, 0))
    last = last.withColumn("upto", upto)
    # The empty prefix ends before the bin.
    none = F.struct(F.abs(F.first("left")).alias("off"), F.lit(0).cast("long").alias("upto"), (F.shiftleft(F.first("bin"), shift) - 1).alias("cut"))
    best = F.min(F.struct(F.abs(F.col("left") - F.col("upto")).alias("off"), F.col("upto"), F.col("__rank").alias("cut")))
    cuts = last.groupBy("__source").agg(F.least(none, best)["cut"].alias("cut"))
    plan = plan.join(cuts.withColumnRenamed("__source", "__of"), F.col("__source").eqNullSafe(F.col("__of")), "left").drop("__of", "bin", "left")
    # A sampled source whose prefix ends in no bin takes every document once more.
    return staged(plan.withColumn("cut", F.when(F.col("share") > 0, F.coalesce("cut", F.lit(1 << _RANK_BITS)))), "mix-plan")


def applied(rows: DataFrame, plan: DataFrame) -> DataFrame:
    joined = _with_plan(rows, plan)
    once_more = F.coalesce((_rank() <= F.col("cut")).cast("long"), F.lit(0))
    taken = F.col("__size") * (F.col("copies") + once_more)
    out = joined.select("*", taken.alias("taken"), F.col("__size").alias("size"))
    return out.select(*[c for c in out.columns if not c.startswith("__")]).drop("mean_liking", "copies", "share", "cut")


def mix(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
    weights: Sequence[int] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = 42, keep: Sequence[str] | None = None,
) -> DataFrame:
    """The columns `keep` (all, if not given) of every document, with `size`, `source_size`,
    `target` (its source's) and `taken` (words taken from it, repeats counted)."""
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in RESULT]
    own = {c: f"own_{k}" for k, c in enumerate(docs.columns)}
    rows = measured(docs.toDF(*own.values()), own[key], own[source], own[text], seed)
    rows = rows.select(*[own[c] for c in keep], "__source", "__size", "__liking", "__u")
    slim = staged(rows.select(*([own[c] for c in keep] if text not in keep else []), "__source", "__size", "__liking", "__u"), "mix-sizes")
    out = applied(slim if text not in keep else rows, plan_of(slim, weights, max_copies))
    return out.select(*[F.col(own[c]).alias(c) for c in keep], *RESULT)


#: The same in DuckDB, from a table `documents`.
SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents),
e AS (SELECT *, size * 1000 // (size + {HALF_LENGTH}) AS liking FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, sum(size * liking)::DOUBLE / (sum(size) * 1000)::DOUBLE AS mean,
  [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]::DOUBLE AS weight FROM e GROUP BY source),
l AS (SELECT *, source_size * 3::DOUBLE AS cap, source_size * 3::DOUBLE / weight AS ratio FROM s),
v AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS lv
  FROM l WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, least(cap, weight * (SELECT min_by(lv, ratio) FROM v WHERE lv <= ratio)) AS target FROM v),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
p AS (SELECT source, source_size, target, coalesce(mean, 0) AS mean, floor(rate)::BIGINT AS copies, rate - floor(rate) AS share,
  target - floor(rate) * source_size AS rest FROM r),
j AS (SELECT e.*, p.source_size, p.target, p.copies, p.share, p.rest,
  p.share + p.share * (1.0::DOUBLE - p.share) * ((liking / 1000.0::DOUBLE - mean) / greatest(mean, 1.0::DOUBLE - mean)) AS pi
  FROM e JOIN p ON e.source IS NOT DISTINCT FROM p.source),
q AS (SELECT *, CASE WHEN share > 0 THEN (u / (1.0::DOUBLE - u)) * ((1.0::DOUBLE - pi) / pi) END AS q FROM j),
k AS (SELECT *, floor(q / (1.0::DOUBLE + q) * 1125899906842624::DOUBLE)::BIGINT AS rank FROM q),
c AS (SELECT *, CASE WHEN share > 0 THEN sum(size) OVER (PARTITION BY source ORDER BY rank RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS upto FROM k),
n AS (SELECT source, min({{'off': abs(rest - upto), 'upto': upto::BIGINT}}) AS best, any_value(rest) AS rest FROM c WHERE share > 0 GROUP BY source),
m AS (SELECT source, CASE WHEN best.off < rest THEN best.upto ELSE 0 END AS words FROM n)
SELECT doc_id, size, source_size, target,
  size * (copies + CASE WHEN share > 0 AND upto <= words THEN 1 ELSE 0 END) AS taken
FROM c LEFT JOIN m ON c.source IS NOT DISTINCT FROM m.source
"""
