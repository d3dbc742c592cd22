"""One registered query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.llm import codes, conversations, decontaminate, licenses, mixing, near_dup, neighbours, pii, quality, repeats, secrets, spans, tool_calls, toxicity
from gleanwork.operators.skew import equi_join
from gleanwork.session import staged

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), keep=["doc_id"])


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), ["doc_id"])


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), ["doc_id"])


def _counted(found: DataFrame, kinds: list[str]) -> DataFrame:
    own = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(own, k))).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(spans.written(F.col("base")), 256).alias("base_sha256"), spans.written(F.col("spans")).alias("spans"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(secrets.find_secrets(_table(spark, sf_dir, "documents"), ["doc_id"]), list(secrets.STRONG))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(pii.find_pii(_table(spark, sf_dir, "documents"), ["doc_id"]), list(pii.STRICT))


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.link_calls(*tool_calls.calls_of(_table(spark, sf_dir, "conversations")), tool_calls.SCHEMAS)


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id", "n_words", decontaminate.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"),
    )


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations")
    rows = conversations.rows_of(conversations.damaged(given), "conv", copies="copies")
    return conversations.report(given.select(F.col("conv_id").alias("conv")), rows).withColumnRenamed("conv", "conv_id")


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, coder = codes.compress(_table(spark, sf_dir, "embeddings"))
    coded = staged(coded, "codes")
    sums = coded.groupBy("label").agg(codes.clipped(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error"))
    joined = equi_join(coded, sums, ["label"], "left", spread_by=["id"])
    return joined.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(coder.digest() if coder else None).cast("string").alias("codebooks_sha256"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_notices(_table(spark, sf_dir, "documents"), ["doc_id"])
    starts = F.transform("base", lambda x: x["start"])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        licenses.labels("base").alias("base_labels"), licenses.labels("base", "notices").alias("labels"), "score",
    )


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_mixing, op2_near_duplicates, op3_quality, op4_toxicity, op5_secrets, op6_pii, op7_tool_calls, op8_neighbours, op9_decontamination, op10_repeats, op11_conversations, op12_codes, op13_licenses)}


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": mixing.SQL, "op7_tool_calls": tool_calls.SQL, "op11_conversations": conversations.SQL, "op12_codes": codes.SQL}
