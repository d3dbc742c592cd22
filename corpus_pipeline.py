"""From raw documents to a training mix: reject poor texts, keep one of each group of near-copies, drop
documents that hold benchmark passages, replace personal data, and mix the sources to weights."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.llm import decontaminate, mixing, near_dup, pii, quality
from gleanwork.session import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`n_chars` follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the words it takes from each, repeats counted."""
    return mixing.mix(docs).filter(F.col("taken") > 0)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality), ("near_duplicates", one_of_each), ("decontamination", decontaminated), ("pii", without_pii), ("mixing", mixed),
]
#: The classifier cannot be stated in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
