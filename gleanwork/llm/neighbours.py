"""Approximate nearest neighbours by inner product: probed lists and an adaptive dimension scan.

The index is fitted on a bounded sample (the smallest by hash of id; 4 per root of the number of vectors, at least `SAMPLE`, at most
`MOST_SAMPLE`): a random rotation, the centres of the lists, of which there are a quarter of that root, and how many lists a query probes. That number is the smallest
whose recall among the sample reaches `SAMPLE_RECALL`, so clustered vectors need few lists and
vectors without structure most of them. A query probes further ones until they hold k vectors besides its own. Every vector is indexed.

Lists are cut into parts and their queries too, so a tile has at most about `PART` of each however
full a list is. A tile rotates its vectors and looks at them in blocks of columns. An inner product of at least
the query's bound is a squared distance of at most |q|^2 + |x|^2 - 2 bound. After d of D rotated columns
the partial squared distance times D / d estimates the whole one, and a candidate is given up if that
exceeds (1 + DEVIATIONS / sqrt(d))^2 times the allowed one. The bound starts at the score of the `2 k`-th
sample vector in the probed lists. Kept candidates are scored anew on the original vectors in
double precision.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part, nor do rows without id. Rows with the query's id are its own. Ties go to the smaller id; equal
(id, score) rows count one each. Empty table: empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.session import staged

SAMPLE, MOST_SAMPLE = 4096, 65_536
SAMPLE_RECALL = 0.97
PART = 8192
COLUMNS = 16
#: Of a partial distance, in units of 1 / sqrt(columns seen).
DEVIATIONS = 2.5


@dataclass
class Index:
    rotation: np.ndarray
    centres: np.ndarray
    probes: int
    k: int
    sample: np.ndarray
    sample_ids: np.ndarray
    sample_lists: np.ndarray
    #: Vectors in each list, once they are known.
    sizes: np.ndarray | None = None


def nearest_centre(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(x @ centres.T - (centres * centres).sum(axis=1) / 2, axis=1)


def _centres(x: np.ndarray, lists: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = x[rng.permutation(len(x))[:lists]].copy()
    for _ in range(rounds):
        mine = nearest_centre(x, centres)
        for c in range(lists):
            if (mine == c).any():
                centres[c] = x[mine == c].mean(axis=0)
    return centres


def _probes(x: np.ndarray, mine: np.ndarray, centres: np.ndarray, k: int) -> int:
    """The fewest lists at which queries from the sample find `SAMPLE_RECALL` of their nearest."""
    q = x[: min(len(x), 256)]
    scores = q @ x.T
    scores[np.arange(len(q)), np.arange(len(q))] = -np.inf
    k = min(k, len(x) - 1)
    if k < 1 or len(centres) == 1:
        return len(centres)
    best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    place = np.argsort(np.argsort(-(q @ centres.T), axis=1), axis=1)
    needed = np.take_along_axis(place, mine[best], axis=1).ravel()
    return int(np.quantile(needed, SAMPLE_RECALL, method="higher")) + 1


def _sampled(vectors: DataFrame, n: int, size: int) -> pa.Table:
    """The rows smallest by hash of id. Of large tables only hashes up to a bound that about 4 * size rows keep are ordered, unless
    repeated ids leave too few of them."""
    few = vectors
    if n > 8 * size:
        few = vectors.filter(F.xxhash64("id") < -(1 << 63) + (1 << 64) * 4 * size // n)
        if few.limit(size).count() < size:
            few = vectors
    return few.orderBy(F.xxhash64("id"), "id").limit(size).toArrow()


def fit(vectors: DataFrame, n: int, k: int, seed: int = 5) -> Index:
    """From columns id, v. The driver sees at most `MOST_SAMPLE` vectors."""
    size = max(SAMPLE, min(MOST_SAMPLE, round(4 * math.sqrt(n))))
    rows = _sampled(vectors, n, size)
    x = _matrix(rows["v"])
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))[0]
    lists = max(1, min(round(math.sqrt(n) / 4), len(x) // 16))
    centres = _centres(x, lists, rng)
    mine = nearest_centre(x, centres)
    return Index(rotation, centres, _probes(x, mine, centres, k), k, x, rows["id"].to_numpy(), mine)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): the rows that take part."""
    v = F.col(vector).cast("array<double>")
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(key).alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    return rows.filter(~odd & F.exists("v", lambda x: x != 0.0))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _listed(index) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                mine = nearest_centre(_matrix(batch.column("v")), index.value["centres"])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(mine.astype(np.int32))], names=["id", "v", "list"])
    return run


def _probed(index) -> Callable:
    """Each query with the lists it probes and its first bound. `copies` rows have its id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i = Index(**index.value)
        for batch in batches:
            if not len(batch):
                continue
            q, ids = _matrix(batch.column("v")), batch.column("id").to_numpy()
            order = np.argsort(-(q @ i.centres.T), axis=1, kind="stable").astype(np.int32)
            enough = i.k + batch.column("copies").to_numpy()
            held = np.cumsum(i.sizes[order], axis=1) < enough[:, None]
            lists = [x[:max(i.probes, n + 1)] for x, n in zip(order, held.sum(axis=1).tolist(), strict=True)]
            bounds = np.full(len(q), -np.inf)
            for r in range(len(q)):
                scores = i.sample[np.isin(i.sample_lists, lists[r]) & (i.sample_ids != ids[r])] @ q[r]
                if len(scores) >= 2 * i.k:
                    bounds[r] = np.partition(scores, -2 * i.k)[-2 * i.k]
            probed = pa.ListArray.from_arrays(np.cumsum([0, *map(len, lists)], dtype=np.int32), pa.array(np.concatenate(lists)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(bounds), probed], names=["id", "v", "bound", "lists"])
    return run


def scan(q: np.ndarray, x: np.ndarray, blocks: np.ndarray, bound: float) -> np.ndarray:
    """Rows of x (rotated, as q) that may score `bound` or more; blocks: squared length of each row
    within each block of columns."""
    # An inner product of `bound` is a squared distance of `far`.
    far = blocks.sum(axis=1) + q @ q - 2 * bound
    alive = np.flatnonzero(far > -1e-9)
    so_far = np.zeros(len(alive))
    for b, at in enumerate(range(0, len(q), COLUMNS)):
        part = q[at:at + COLUMNS]
        so_far = so_far + blocks[alive, b] + part @ part - 2 * (x[alive, at:at + COLUMNS] @ part)
        seen = min(at + COLUMNS, len(q))
        slack = (1 + DEVIATIONS / math.sqrt(seen)) ** 2 if seen < len(q) else 1.0
        keep = so_far * (len(q) / seen) <= far[alive] * slack + 1e-9
        alive, so_far = alive[keep], so_far[keep]
    return alive


def _searched(index) -> Callable:
    def run(key: tuple, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        i = Index(**index.value)
        out: dict[str, list] = {"query_id": [], "best": []}
        if len(vectors) and len(queries):
            raw, ids = _matrix(vectors["v"]), vectors["id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            raw, ids = raw[order], ids[order]
            x = raw @ i.rotation
            blocks = np.stack([(x[:, at:at + COLUMNS] ** 2).sum(axis=1) for at in range(0, x.shape[1], COLUMNS)], axis=1)
            turned = _matrix(queries["v"]) @ i.rotation
            for r, (q_id, bound) in enumerate(zip(queries["id"].to_pylist(), queries["bound"].to_pylist(), strict=True)):
                q = _matrix(queries["v"].slice(r, 1))[0]
                if bound == -np.inf and len(x) > 4 * i.k:
                    first = raw[: 4 * i.k][ids[: 4 * i.k] != q_id] @ q
                    bound = np.partition(first, -i.k)[-i.k] if len(first) >= i.k else bound
                found = scan(turned[r], x, blocks, bound)
                found = found[ids[found] != q_id]
                # Summed by one rule wherever a row lies, so that equal vectors score alike.
                score = np.add.reduce(raw[found] * q, axis=1)
                best = np.lexsort((ids[found], -score))[: i.k]
                if len(best):
                    out["query_id"].append(q_id)
                    out["best"].append([{"below": -s, "vec_id": v} for s, v in zip(score[best].tolist(), ids[found][best].tolist(), strict=True)])
        best = pa.list_(pa.struct([("below", pa.float64()), ("vec_id", pa.int64())]))
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "best": pa.array(out["best"], best)})
    return run


def search(vectors: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row for which `queries` (an expression of the id,
    named `id`) holds, its k nearest among the others."""
    rows = usable(vectors, key, vector).withColumn("id", F.col("id").cast("long"))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
    usual = sizes.orderBy(F.desc("n"), "d").first()
    spark = vectors.sparkSession
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("v") == usual["d"])
    fitted = fit(rows, usual["n"], k)
    index = spark.sparkContext.broadcast(vars(fitted))
    listed = staged(rows.mapInArrow(_listed(index), "id long, v array<double>, list int"), "listed")
    fitted.sizes = np.zeros(len(fitted.centres), dtype=np.int64)
    for r in listed.groupBy("list").count().collect():  # a row per list
        fitted.sizes[r["list"]] = r["count"]
    index = spark.sparkContext.broadcast(vars(fitted))
    wanted = listed.filter(queries)
    wanted = wanted.join(wanted.groupBy("id").agg(F.count("*").alias("copies")), "id").select("id", "v", "copies")
    asked = staged(wanted.mapInArrow(_probed(index), "id long, v array<double>, bound double, lists array<int>"), "asked")
    probing = asked.select("id", "v", "bound", F.explode("lists").alias("list"))
    parts = lambda df, name: df.groupBy("list").agg(F.ceil(F.count("*") / F.lit(PART)).cast("int").alias(name))
    plan = staged(parts(listed, "parts").join(parts(probing, "q_parts"), "list"), "plan")
    spread = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = listed.join(plan, "list").select("list", spread("parts").alias("i"), each("q_parts").alias("j"), "id", "v")
    met = probing.join(plan, "list").select("list", spread("q_parts").alias("j"), each("parts").alias("i"), "id", "v", "bound")
    found = own.groupBy("list", "i", "j").cogroup(met.groupBy("list", "i", "j")).applyInArrow(
        _searched(index), "query_id long, best array<struct<below:double,vec_id:long>>")
    # At most k of each tile: a query's list is as long as the tiles it probes, times k.
    best = found.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    ranked = best.select("query_id", F.posexplode("best").alias("place", "one"))
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), "one.vec_id", (-F.col("one.below")).alias("score"))
