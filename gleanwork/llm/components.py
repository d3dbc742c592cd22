"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gleanwork.session import released, staged

#: Links of one chunk, see `_contracted`.
CHUNK = 1 << 16


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reachable) for every node of the links that is not the smallest of its own."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    low = np.arange(len(nodes))
    while len(x):
        least = np.minimum(low[x], low[y])
        np.minimum.at(low, low[x], least)
        np.minimum.at(low, low[y], least)
        while not np.array_equal(low[low], low):
            low = low[low]
        open_ = low[x] != low[y]
        x, y = x[open_], y[open_]
    moved = np.flatnonzero(low != np.arange(len(nodes)))
    return nodes[moved], nodes[low[moved]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk of a task's links as stars with the same components. Chunks bound the memory; what they do not join, the rounds do."""
    held: list[pa.RecordBatch] = []

    def out() -> pa.RecordBatch:
        ends = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("a", "b"))
        kinds = held[0].schema.types
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(_stars(*ends), kinds, strict=True)], names=["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= CHUNK:
            yield out()
            held.clear()
    if held:
        yield out()


def _each(rows: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """(a, b) of every pair of columns; not a union, which would have the driver plan what makes the rows once for each."""
    return rows.select(F.inline(F.array(*[F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in pairs])))


def _lowest(both: DataFrame) -> tuple[DataFrame, int]:
    """The smallest neighbour of every node, written, and how many nodes are not settled yet.

    Distinct links are stars around their smallest nodes, which no round changes, if every node with a smaller neighbour
    has no other: the other end of its link then has no smaller one. Written first also so that Spark can split the links of a hub.
    """
    seen = Observation()
    rows = both.groupBy("a").agg(F.min("b").alias("low"), F.count(F.lit(1)).alias("n"))
    rows = staged(rows.observe(seen, F.count_if((F.col("low") < F.col("a")) & (F.col("n") > 1)).alias("open")).drop("n"), "lowest")
    return rows, seen.get["open"]


def _starred(both: DataFrame, lowest: DataFrame) -> DataFrame:
    larger = both.join(lowest, "a").filter(F.col("b") > F.col("a"))
    links = larger.select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct()
    smallest = links.groupBy("a").agg(F.min("b").alias("low"))
    return _each(links.join(smallest, "a"), ("a", "low"), ("b", "low")).filter("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, low): the smallest node reachable, for every node that has a larger-numbered end of a
    link. Nodes not listed are the smallest of theirs. Links are (a, b) of whole numbers.

    Links are contracted within chunks first, without a shuffle. Every round is written to the shared folder, so a lost executor
    costs one round. Rounds grow with the logarithm of the longest chain; none is spent on links that are stars already.
    """
    links = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = staged(links.mapInArrow(_contracted, links.schema).distinct(), "links")
    # Without rows Spark drops the observation from the plan.
    unsettled = not links.isEmpty()
    while unsettled:
        released(links.sparkSession)
        both = _each(links, ("a", "b"), ("b", "a"))
        lowest, unsettled = _lowest(both)
        if unsettled:
            links = staged(_starred(both, lowest), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("low"))
