"""Joins, lookups and key-set operators.

`spread_by` names a row ordinal of the (large) left side; with it the rows of hot keys are
spread over many tasks, see `operators.skew`. Without it skew is left to adaptive execution.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.operators.skew import equi_join

Spread = Sequence[str] | None


def merge(
    left: DataFrame,
    right: DataFrame,
    on: str,
    null_keys: str = "match",
    suffixes: tuple[str, str] = ("_x", "_y"),
    spread_by: Spread = None,
    right_spread_by: Spread = None,
) -> DataFrame:
    """Inner equi join; columns present on both sides get suffixes, missing keys match."""
    shared = [c for c in left.columns if c in right.columns and c != on]
    renames = [{c: c + suffix for c in shared} for suffix in suffixes]
    lhs, rhs = left.withColumnsRenamed(renames[0]), right.withColumnsRenamed(renames[1])
    spreads = [
        by and [renamed.get(c, c) for c in by]
        for by, renamed in zip((spread_by, right_spread_by), renames, strict=True)
    ]
    return equi_join(lhs, rhs, [on], "inner", null_keys, *spreads)


def _key_set(df: DataFrame, key: str, as_name: str) -> DataFrame:
    """Distinct keys: collapsed before the shuffle, so a hot key arrives once per task."""
    return df.select(F.col(key).alias(as_name)).distinct()


def members(
    df: DataFrame, other: DataFrame, key: str, other_key: str | None = None, spread_by: Spread = None
) -> DataFrame:
    """Rows whose key occurs in the other frame; a missing key is an ordinary member."""
    keys = _key_set(other, other_key or key, key)
    return equi_join(df, keys, [key], "left_semi", "match", spread_by)


def non_members(
    df: DataFrame, other: DataFrame, key: str, other_key: str | None = None, spread_by: Spread = None
) -> DataFrame:
    keys = _key_set(other, other_key or key, key)
    return equi_join(df, keys, [key], "left_anti", "match", spread_by)


def missing_ids(ids: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Set difference of key columns."""
    return non_members(ids, known, key)


def add_missing_ids(
    cohort: DataFrame, base: DataFrame, ids: DataFrame, key: str, spread_by: Spread = None
) -> DataFrame:
    """The cohort plus every base row of a listed id the cohort lacks."""
    wanted = missing_ids(ids.select(key).distinct(), cohort, key)
    return cohort.unionByName(members(base, wanted, key, spread_by=spread_by), allowMissingColumns=True)


def lookup_last(
    df: DataFrame, dim: DataFrame, key: str, values: Sequence[str], ord_col: str,
    dim_key: str | None = None, spread_by: Spread = None,
) -> DataFrame:
    """Attach dimension values by name; of repeated names the last row wins, a miss gives nulls."""
    dim_key = dim_key or key
    last = (
        dim.filter(F.col(dim_key).isNotNull())
        .groupBy(F.col(dim_key).alias(key))
        .agg(F.max_by(F.struct(*values), F.col(ord_col)).alias("__found"))
    )
    joined = equi_join(df, last, [key], "left", "drop", spread_by)
    return joined.select(*df.columns, *[F.col(f"__found.{v}").alias(v) for v in values])


def seed_pages(seeds: DataFrame, pages: int) -> DataFrame:
    """Every seed with page numbers 1..pages; each row expands in place."""
    return seeds.withColumn("page", F.explode(F.sequence(F.lit(1), F.lit(pages))))


def update_from(
    base: DataFrame, edits: DataFrame, key: str, updates: Mapping[str, Column], spread_by: Spread = None
) -> DataFrame:
    """Apply column expressions to the base rows whose key is in `edits`; the rest is unchanged."""
    edited = _key_set(edits, key, key).withColumn("__edit", F.lit(True))
    marked = equi_join(base, edited, [key], "left", "match", spread_by)
    hit = F.coalesce(F.col("__edit"), F.lit(False))
    return marked.select(
        *[F.when(hit, updates[c]).otherwise(F.col(c)).alias(c) if c in updates else F.col(c)
          for c in base.columns]
    )


def overwrite_from(
    base: DataFrame, edits: DataFrame, key: str, columns: Sequence[str], spread_by: Spread = None
) -> DataFrame:
    """Replace columns of the base rows by those of the edited row with the same key.

    `edits` has one row per key; a replaced value may be null.
    """
    values = edits.select(key, F.struct(*columns).alias("__new"))
    joined = equi_join(base, values, [key], "left", "match", spread_by)
    hit = F.col("__new").isNotNull()
    return joined.select(
        *[F.when(hit, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
          for c in base.columns]
    )


def frontier(
    urls: DataFrame, ledger: DataFrame, key: str, retry_failed: bool = True, spread_by: Spread = None
) -> DataFrame:
    """URLs still to fetch. Completed and dead ones are done; failed ones stay in unless `retry_failed` is off."""
    done = ledger.filter(F.col("status").isin("completed", "dead")) if retry_failed else ledger
    return non_members(urls, done, key, spread_by=spread_by)


def attach_results(
    requests: DataFrame, results: DataFrame, key: str, defaults: Mapping[str, str], spread_by: Spread = None
) -> DataFrame:
    """Every request keeps a row; payload columns it lacks take their default text."""
    joined = equi_join(requests, results, [key], "left", "drop", spread_by)
    payload = [c for c in results.columns if c != key]
    return joined.select(
        *requests.columns,
        *[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c)
          for c in payload],
    )
