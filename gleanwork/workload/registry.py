"""Query registry. A query is (spark, sf_dir) -> DataFrame; its SQL runs on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleanwork import lexicons as lx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with its SQL if there is one."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """For queries with much work per row: the table's columns, in as many parts as the session has cores if the table has fewer files.

    A table of one small file would be worked on by one core; a large one is split as it is read.
    """
    df = table(spark, sf_dir, name).select(*columns)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


# --- SQL snippets ---------------------------------------------------------------------------


def sql_strip(expr: str) -> str:
    return f"trim({expr}, '{lx.WHITESPACE}')"


def sql_any(expr: str, words) -> str:
    return "(" + " OR ".join(f"contains({expr}, '{w}')" for w in words) + ")"


def sql_presence(expr: str, words) -> str:
    return "(" + " + ".join(f"(contains(lower({expr}), '{w}'))::INTEGER" for w in words) + ")"


def sql_occurrences(expr: str, words) -> str:
    return "(" + " + ".join(
        f"((length(lower({expr})) - length(replace(lower({expr}), '{w}', ''))) // {len(w)})::INTEGER"
        for w in words
    ) + ")"


def sql_rate(a: str, b: str, scale: str = "1.0") -> str:
    return f"coalesce(({a})::DOUBLE / nullif(({b})::DOUBLE, 0) * {scale}, 0.0)::DOUBLE"
