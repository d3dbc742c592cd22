"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gleanwork.session import staged

_SALTS = "__salts"
_SALT = "__salt"


def key_condition(left: Sequence[str], right: Sequence[str], null_keys: str) -> Column:
    """Equality of two lists of column names; with null_keys='match' two missing keys are equal."""
    if null_keys not in ("match", "drop"):
        raise ValueError("null_keys must be 'match' or 'drop'")
    pairs = [
        F.col(a).eqNullSafe(F.col(b)) if null_keys == "match" else F.col(a) == F.col(b)
        for a, b in zip(left, right, strict=True)
    ]
    return reduce(lambda x, y: x & y, pairs)


def rename_keys(df: DataFrame, keys: Sequence[str], prefix: str) -> tuple[DataFrame, list[str]]:
    """The frame with its keys under fresh names, so a self join is never ambiguous."""
    names = [prefix + k for k in keys]
    return df.withColumnsRenamed(dict(zip(keys, names, strict=True))), names


def hot_keys(df: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """Keys owning more rows than a fair part, with the number of salts that makes them fair.

    One pass over the rows, written: keys and the total come from the same counts. Never more than
    `parts` keys, with at most twice `parts` salts among them.
    """
    rows = Observation()
    counts = df.observe(rows, F.count(F.lit(1)).alias("n")).groupBy(*keys).agg(F.count("*").alias("__n"))
    counts = staged(counts.filter("__n > 1"), "key-counts")
    # Without rows Spark drops the observation from the plan, and there is nothing to be had.
    fair = max(1.0, rows.get["n"] / parts) if not counts.isEmpty() else 1.0
    return counts.filter(F.col("__n") > fair).select(*keys, F.ceil(F.col("__n") / F.lit(fair)).cast("int").alias(_SALTS))


def _with_salts(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    # As many rows as there are parts at most, so the broadcast is bounded.
    marks, names = rename_keys(hot, [c for c in hot.columns if c != _SALTS], "__hot_")
    joined = df.join(F.broadcast(marks), key_condition(keys, names, "match"), "left")
    return joined.select(*df.columns, F.coalesce(F.col(_SALTS), F.lit(1)).alias(_SALTS))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    null_keys: str = "match",
    right_spread_by: Sequence[str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Join with the rows of hot keys spread over as many partitions as their share asks for.

    A left row of a key that holds more than one of `parts` fair parts (the shuffle partitions, if
    not given) takes a salt from `spread_by` (a row ordinal, so a recomputed task gives the same
    salt), and the right rows of that key are repeated once per salt. With `right_spread_by` keys
    that are hot on the right are treated the same way round (inner joins only). All other rows
    stay single, so the result is that of the plain join. Key columns come from the left; other
    shared names must be resolved by the caller.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join does not support {how!r}")
    if right_spread_by and how != "inner":
        raise ValueError("right_spread_by needs an inner join")
    parts = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    renamed, names = rename_keys(right, keys, "__right_")
    sides = [(left, keys), (renamed, names)]
    salted = [(hot_keys(left, keys, parts), spread_by)]
    if right_spread_by:
        own = [names[keys.index(c)] if c in keys else c for c in right_spread_by]
        salted.append((hot_keys(renamed, names, parts), own))
    condition = key_condition(keys, names, null_keys)
    if all(hot.isEmpty() for hot, _ in salted):
        # Nothing to spread: rows that lie by their key already are not moved again.
        return left.join(renamed, condition, how).drop(*names)
    for side, (hot, spread) in enumerate(salted):
        salt = F.pmod(F.xxhash64(*spread), F.col(_SALTS)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.col(_SALTS) - 1))
        made = []
        for i, (df, df_keys) in enumerate(sides):
            counted = _with_salts(df, hot, df_keys)
            made.append((counted.withColumn(f"{_SALT}_{side}_{i}", salt if i == side else copies).drop(_SALTS), df_keys))
        sides = made
        condition = condition & (F.col(f"{_SALT}_{side}_0") == F.col(f"{_SALT}_{side}_1"))
    extra = [f"{_SALT}_{s}_{i}" for s in range(len(salted)) for i in (0, 1)]
    return sides[0][0].join(sides[1][0], condition, how).drop(*extra, *names)


def equi_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    null_keys: str = "match",
    spread_by: Sequence[str] | None = None,
    right_spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Salted when a row ordinal is given; otherwise skew is left to adaptive execution."""
    if spread_by:
        return salted_join(left, right, keys, spread_by, how, null_keys, right_spread_by)
    renamed, names = rename_keys(right, keys, "__right_")
    return left.join(renamed, key_condition(keys, names, null_keys), how).drop(*names)
