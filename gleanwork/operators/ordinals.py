"""Global row positions, batches, shards, slices and samples without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.operators.skew import equi_join
from gleanwork.session import staged


#: Up to this rank the first rows are taken by a top-k, whose rows meet in one task.
TOP = 100_000
#: Buckets that a round of counting has, and rows that the last bucket may hold.
_BUCKETS, _FEW = 4096, 1_000_000


def _as_number(df: DataFrame, ord_col: str) -> Column | None:
    """A whole number in the order of the column, if it has one by its type."""
    kind = dict(df.dtypes)[ord_col]
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(ord_col).cast("timestamp"))
    return F.col(ord_col).cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else None


def _positions(df: DataFrame, ord_col: str, out: str, parts: int | None) -> tuple[DataFrame, int]:
    split = df.repartitionByRange(*([parts] if parts else []), ord_col).sortWithinPartitions(ord_col)
    # The number of the part, and that of the row in it.
    numbered = staged(split.withColumn("__at", F.monotonically_increasing_id()), "ranged")
    part, local = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = sorted((r["part"], r["n"]) for r in numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before = [0, *accumulate(n for _, n in sizes)]
    # As many rows as there are parts.
    starts = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "__part INT, __before LONG")
    placed = numbered.join(F.broadcast(starts), part.cast("int") == F.col("__part"))
    return placed.select(*df.columns, (F.col("__before") + local).alias(out)), before[-1]


def with_position(df: DataFrame, ord_col: str, out: str = "position", parts: int | None = None) -> DataFrame:
    """Zero-based position of every row by a unique ordinal of any type that sorts; nulls first.

    Rows are split into ranges by Spark's range partitioner, whose splitters come from a bounded sample of every partition, and sorted in
    each range; a row's number there is shifted by the size of the ranges before. The split rows are written, so that sizes and numbers agree
    whatever is computed again. Only the size of each range is ever in one place.
    """
    return _positions(df, ord_col, out, parts)[0]


def batch_ids(df: DataFrame, ord_col: str, size: int) -> DataFrame:
    """Consecutive batches of `size` rows."""
    return with_position(df, ord_col).withColumn("batch_id", F.expr(f"position div {int(size)}"))


def shards(df: DataFrame, ord_col: str, n: int) -> DataFrame:
    """Contiguous shards of equal floor size; the last one takes the remainder."""
    placed, total = _positions(df, ord_col, "position", None)
    size = total // int(n)
    if not size:
        return placed.withColumn("shard_id", F.lit(n - 1).cast("long"))
    return placed.withColumn("shard_id", F.expr(f"least(position div {size}L, {n - 1}L)"))


def _range_of_rank(df: DataFrame, number: Column, rank: int, few: int) -> tuple[int, int, int] | None:
    """(lowest, highest, before): numbers between which the row of that rank lies, among at most about `few` rows, and how many rows
    are below. Rounds of counts in at most `_BUCKETS` buckets, added up before any shuffle. None if there are no such rows."""
    rows = df.select(number.alias("x"))
    ends = rows.agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("x").alias("n")).first()
    low, high, n, before = ends["low"], ends["high"], ends["n"], 0
    if rank >= n:
        return None
    while n > few and low < high:
        shift = max(0, (high - low).bit_length() - _BUCKETS.bit_length() + 2)
        counts = rows.filter(F.col("x").between(low, high)).groupBy(F.shiftright("x", shift).alias("b")).agg(F.count("*").alias("n")).collect()
        for r in sorted(counts, key=lambda r: r["b"]):
            n = r["n"]
            if before + n > rank:
                low, high = max(low, r["b"] << shift), min(high, (r["b"] + 1 << shift) - 1)
                break
            before += n
    return low, high, before


def row_slice(df: DataFrame, ord_col: str, start: int, stop: int, top: int = TOP, few: int = _FEW) -> DataFrame:
    """Rows [start, stop) in the order of a unique ordinal.

    A top-k near the beginning. Further on the values at both ends are found by rounds of counting, and only the rows
    between them are placed; an ordinal that is no whole number or time has all rows placed. No task holds more than a range.
    """
    if stop <= top:
        return df.orderBy(ord_col).offset(start).limit(stop - start)
    number, skipped = _as_number(df, ord_col), 0
    if number is not None:
        nulls = df.filter(F.col(ord_col).isNull()).count()
        first = _range_of_rank(df, number, max(0, start - nulls), few) if start >= nulls else None
        last = _range_of_rank(df, number, stop - 1 - nulls, few)
        if start >= nulls and first is None:
            return df.filter(F.lit(False))
        near = F.lit(True)
        if first is not None:
            near, skipped = near & (number >= first[0]), nulls + first[2]
        if last is not None:
            near = near & (number.isNull() | (number <= last[1]))
        df = df.filter(near)
    placed = with_position(df, ord_col, "__position")
    kept = placed.filter((F.col("__position") >= start - skipped) & (F.col("__position") < stop - skipped))
    return kept.drop("__position").orderBy(ord_col)


def first_rows(df: DataFrame, ord_col: str, n: int) -> DataFrame:
    return row_slice(df, ord_col, 0, n)


def repeatable_sample(df: DataFrame, key: str, n: int, seed: int = 0, top: int = TOP, few: int = _FEW) -> DataFrame:
    """n rows in an order fixed by a digest of the key and the seed.

    A large sample is all rows below the digest at rank n, found by rounds of counting; only the few rows around it are sorted.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")))
    if n <= top:
        return df.orderBy(digest, key).limit(n)
    number = F.coalesce(F.conv(F.substr(digest, F.lit(1), F.lit(15)), 16, 10).cast("long"), F.lit(-1).cast("long"))
    found = _range_of_rank(df, number, n - 1, few)
    if found is None:
        return df
    low, high, before = found
    around = df.filter((number >= low) & (number <= high)).orderBy(digest, key).limit(n - before)
    return df.filter(number < low).unionByName(around)


def early_stop(
    pages: DataFrame, seed: str, page: str, n_items: str, failed: str | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Pages of a seed before its first empty or failed one.

    The stop page is a map-side combined minimum per seed, so no seed is held as a group.
    """
    empty = F.coalesce(F.col(n_items), F.lit(0)) == 0
    if failed:
        empty = empty | F.coalesce(F.col(failed), F.lit(False))
    stops = pages.filter(empty).groupBy(seed).agg(F.min(page).alias("__stop"))
    return (
        equi_join(pages, stops, [seed], "left", "match", spread_by)
        .filter(F.col("__stop").isNull() | (F.col(page) < F.col("__stop")))
        .drop("__stop")
    )
