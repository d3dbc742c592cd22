"""Keep-first duplicate removal and result merging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanwork.functions.text import normalized_key
from gleanwork.session import staged
from gleanwork.sources import batches


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the lowest in `order`; missing keys are equal.

    `row_number = 1` is planned as a group limit in front of the shuffle: each task forwards at
    most one row per key, however many copies it holds.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def dedup_exact_title(df: DataFrame, title: str, order: str) -> DataFrame:
    return keep_first(df, [F.coalesce(F.col(title), F.lit(""))], [order])


def dedup_normalized_title(df: DataFrame, title: str, order: str) -> DataFrame:
    return keep_first(df, [normalized_key(F.coalesce(F.col(title), F.lit("")))], [order])


def ordered_distinct(df: DataFrame, column: str, order: str) -> DataFrame:
    """Distinct non-null values with the ordinal of their first occurrence."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.min(order).alias(order))


def union_all(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; a column a frame lacks is null there."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def merge_generations(frames: Sequence[DataFrame], key: str, order: str) -> DataFrame:
    """Stack result sets, oldest first, and keep the first row of each key."""
    stacked = union_all(*[df.withColumn("generation", F.lit(i)) for i, df in enumerate(frames)])
    return keep_first(stacked, [key], ["generation", order])


def add_generation(new: DataFrame, kept: str, key: str, order: str, name: str, buckets: int = 64) -> None:
    """Merge one more result set into the kept result at `kept`, by its keys only; earlier sets win, as in `merge_generations`.

    The kept result is a table of batches, one per set, each split by a hash of the key. Only the keys of the buckets that the new set hits
    are read; the rows of keys not kept yet are added, and nothing is written anew. Repeated under its name a set replaces what it added.
    Missing keys are equal. The same number of buckets must be given for all sets.
    """
    spark = new.sparkSession
    bucket = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(buckets)).cast("int")
    first = staged(keep_first(new, [key], [order]).withColumn("__bucket", bucket), "generation")
    hit = [r["__bucket"] for r in first.select("__bucket").distinct().collect()]  # at most `buckets`
    others = [a for b, a in batches.attempts(spark, kept).items() if b != name]
    add = first
    if others and hit:
        known = batches.read_attempts(spark, kept, others).filter(F.col("__bucket").isin(hit)).select(F.col(key).alias("__known"), F.col("__bucket").alias("__in"))
        add = first.join(known, F.col(key).eqNullSafe(F.col("__known")) & (F.col("__bucket") == F.col("__in")), "left_anti")
    generation = len(others)
    attempt = batches.new_attempt()
    add.withColumn("generation", F.lit(generation)).repartition("__bucket", key).write.partitionBy("__bucket").parquet(batches.folder(kept, attempt))
    batches.commit(spark, kept, name, attempt)


def read_kept(spark: SparkSession, kept: str) -> DataFrame:
    """The kept result: one row per key; a column that a set lacks is null."""
    return batches.read_batches(spark, kept).drop("__bucket")
