"""Vectors as short codes: each of `PARTS` consecutive parts by the nearest of at most 64 entries.

Components become whole numbers floor(`SCALE` * x). The codebook of a part starts as that part of the vectors
with the smallest ids; each round assigns every part to its nearest entry (squared distance, ties to the lower index)
and moves the entries to the floored means of their parts. An entry without parts stays.

The nearest entry is found exactly by slicing. In each dimension the entries are sorted by their coordinate, and the
entries up to each place form a mask of 64 bits. The distance to some entry near by in one dimension is an initial radius; the
entries within it in a dimension are a range of the sorted ones, whose mask is the difference of two prefix masks. The masks
of all dimensions are ANDed: the bits left are all entries that can be as near, and only to those are distances computed.

A task adds up its parts for each entry, so a round sends one row per task and entry to a sum of large numbers,
and the driver sees no more than 64 vectors, the codebook itself. All passes read the table; nothing is kept between them.

Vectors that are null or hold null or non-finite components are dropped. Rows of another length than most (ties: the
shorter) get a null code and a null error. Lengths that are no multiple of the number of parts are cut as evenly as possible; a part without
components has distance 0 and entry 0. Numbers are exact at any size; an error above the largest long becomes the largest long. Null ids
come last in the codebook's order and equal ids by their vectors; rows may repeat. Empty table: empty result. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
_LONG = (1 << 63) - 1
#: Up to this size of components all sums of a batch fit 64 bits.
_SMALL = 1 << 24


def whole(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), in 64 bits where all are small, else as Python integers."""
    if not x.size or np.abs(x).max() < _SMALL / SCALE:
        return np.floor(x * SCALE).astype(np.int64)
    exact = np.empty(x.shape, dtype=object)
    exact.ravel()[:] = [math.floor(Fraction(v) * SCALE) for v in x.ravel().tolist()]
    return exact


@dataclass
class Slices:
    """The entries of one part, sorted in each dimension, with the mask of the entries up to each place."""

    entries: np.ndarray
    order: np.ndarray
    coordinates: np.ndarray
    prefixes: np.ndarray


def slices(entries: np.ndarray) -> Slices:
    order = np.argsort(entries, axis=0, kind="stable")
    coordinates = np.take_along_axis(entries, order, axis=0)
    prefixes = np.zeros((len(entries) + 1, entries.shape[1]), dtype=np.uint64)
    prefixes[1:] = np.bitwise_or.accumulate(np.left_shift(np.uint64(1), order.astype(np.uint64)), axis=0)
    return Slices(entries, order, coordinates, prefixes)


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return ((x - entries) ** 2).sum(axis=1)


def _radius(squared: np.ndarray) -> np.ndarray:
    """Largest whole number whose square is at most `squared`."""
    if squared.dtype == object:
        return np.array([math.isqrt(s) for s in squared.tolist()], dtype=object)
    return np.sqrt(squared.astype(np.float64)).astype(np.int64) + 1


def nearest(x: np.ndarray, s: Slices) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the lowest of the nearest entries, and its squared distance."""
    n, dims = x.shape
    if not dims:
        return np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    if x.dtype != s.entries.dtype:
        x = x.astype(object)
    limit = None
    for d in range(dims):
        at = np.minimum(np.searchsorted(s.coordinates[:, d], x[:, d]), len(s.entries) - 1)
        away = _distances(x, s.entries[s.order[at, d]])
        limit = away if limit is None else np.minimum(limit, away)
    radius = _radius(limit)
    left = np.full(n, ~np.uint64(0))
    for d in range(dims):
        low = np.searchsorted(s.coordinates[:, d], x[:, d] - radius, "left")
        high = np.searchsorted(s.coordinates[:, d], x[:, d] + radius, "right")
        left &= s.prefixes[high, d] ^ s.prefixes[low, d]
    best = np.full(n, -1, dtype=np.int64)
    error = limit + 1
    rows = np.flatnonzero(left)
    while len(rows):
        bits = left[rows]
        lowest = bits & (~bits + np.uint64(1))
        entry = np.log2(lowest.astype(np.float64)).astype(np.int64)
        away = _distances(x[rows], s.entries[entry])
        nearer = away < error[rows]
        error[rows[nearer]], best[rows[nearer]] = away[nearer], entry[nearer]
        left[rows] = bits ^ lowest
        rows = rows[left[rows] != 0]
    return best, error


Codebook = list[list[list[int]]]


@dataclass(frozen=True)
class Coder:
    """Part -> entry -> components."""

    books: Codebook
    length: int

    def bounds(self) -> list[int]:
        return [self.length * p // PARTS for p in range(PARTS + 1)]

    def slices(self) -> list[Slices]:
        out = []
        for book, a, b in zip(self.books, self.bounds(), self.bounds()[1:]):
            small = all(abs(v) < _SMALL for e in book for v in e)
            out.append(slices(np.array(book, dtype=np.int64 if small else object).reshape(len(book), b - a)))
        return out

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for book in self.books for e in book for v in e).encode()).hexdigest()


def _assigned(x: np.ndarray, coder: Coder, cut: list[Slices]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per part its components, entries and squared distances."""
    bounds = coder.bounds()
    for p, s in enumerate(cut):
        part = x[:, bounds[p]:bounds[p + 1]]
        yield (part, *nearest(part, s))


def usable(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(id, v, label) of the rows that are not dropped."""
    q = lambda c: F.col("`" + c.replace("`", "``") + "`")
    rows = vectors.select(q(key).alias("id"), q(vector).cast("array<double>").alias("v"), q(label).alias("label"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("v").isNotNull() & ~odd)


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length) if length else np.zeros((len(column), 0))


def _added(coder: Coder) -> Callable:
    """The number and the sum of the parts of each entry that a task sees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = coder.slices()
        counts: dict[tuple[int, int], int] = {}
        sums: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            x = whole(_matrix(batch.column("v"), coder.length))
            for p, (part, entries, _) in enumerate(_assigned(x, coder, cut)):
                n = np.bincount(entries, minlength=len(coder.books[p]))
                total = np.zeros((len(n), part.shape[1]), dtype=part.dtype)
                np.add.at(total, entries, part)
                for e in np.flatnonzero(n).tolist():
                    counts[p, e] = counts.get((p, e), 0) + int(n[e])
                    sums[p, e] = [a + b for a, b in zip(sums.get((p, e), [0] * part.shape[1]), total[e].tolist())]
        keys = sorted(counts)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([p for p, _ in keys], pa.int32()), "entry": pa.array([e for _, e in keys], pa.int32()),
            "n": pa.array([counts[k] for k in keys], pa.int64()), "total": pa.array([[str(v) for v in sums[k]] for k in keys], pa.list_(pa.string())),
        })
    return run


def _merged(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of any size, one row after the other."""
    n, total = 0, None
    for rows in tables:
        n += int(np.sum(rows.column("n").to_numpy()))
        for one in rows.column("total").to_pylist():
            one = [int(v) for v in one]
            total = one if total is None else [a + b for a, b in zip(total, one)]
    yield pa.RecordBatch.from_pydict({
        "part": pa.array([key[0].as_py()], pa.int32()), "entry": pa.array([key[1].as_py()], pa.int32()),
        "mean": pa.array([[str(v // n) for v in total or []]], pa.list_(pa.string())),
    })


def _moved(rows: DataFrame, coder: Coder) -> Coder:
    """One round. A row per part and entry comes to the driver."""
    added = rows.select("v").mapInArrow(_added(coder), "part int, entry int, n long, total array<string>")
    means = added.groupBy("part", "entry").applyInArrow(_merged, "part int, entry int, mean array<string>").collect()
    books = [list(book) for book in coder.books]
    for r in means:
        books[r["part"]][r["entry"]] = [int(v) for v in r["mean"]]
    return Coder(books, coder.length)


def start(rows: DataFrame, length: int) -> Coder:
    """From the `ENTRIES` rows with the smallest ids."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(ENTRIES).collect()
    x = [whole(np.array(r["v"], dtype=np.float64)).tolist() for r in first]
    bounds = [length * p // PARTS for p in range(PARTS + 1)]
    return Coder([[v[a:b] for v in x] for a, b in zip(bounds, bounds[1:])], length)


def fit(rows: DataFrame, length: int, rounds: int = ROUNDS) -> Coder:
    coder = start(rows, length)
    for _ in range(rounds):
        coder = _moved(rows, coder)
    return coder


def _coded(coder: Coder) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = coder.slices()
        for batch in batches:
            column = batch.column("v")
            codes = np.zeros((len(batch), PARTS), dtype=np.uint8)
            error: np.ndarray = np.zeros(len(batch), dtype=np.int64)
            usual = np.array([n == coder.length for n in column.value_lengths().to_pylist()], dtype=bool)
            fits = np.flatnonzero(usual)
            if len(fits):
                x = whole(_matrix(column.filter(pa.array(usual)), coder.length))
                own = np.zeros(len(fits), dtype=np.int64)
                for p, (_, entries, away) in enumerate(_assigned(x, coder, cut)):
                    codes[fits, p] = entries
                    own = own + away
                error = error.astype(own.dtype)
                error[fits] = own
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("label"),
                pa.array([c.tobytes().hex() if u else None for c, u in zip(codes, usual)], pa.string()),
                pa.array([min(int(e), _LONG) if u else None for e, u in zip(error.tolist(), usual)], pa.int64()),
            ], names=["id", "label", "code", "error"])
    return run


def encode(rows: DataFrame, coder: Coder) -> DataFrame:
    """(id, label, code, error) of rows (id, v, label)."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(_coded(coder), f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, Coder | None]:
    """(id, label, code, error) and the fitted coder; None where no row can be used."""
    rows = usable(vectors, key, vector, label)
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if usual is None:
        return rows.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), None
    coder = fit(rows.filter(F.size("v") == usual["d"]), usual["d"])
    return encode(rows, coder), coder


def clipped(total: Column) -> Column:
    return F.least(total, F.lit(_LONG).cast("decimal(38,0)")).cast("long")


def _round_sql(k: int) -> str:
    # The least struct: by distance, then by index. The remainder is made positive, so that the quotient is floored.
    return f"""
a{k} AS MATERIALIZED (SELECT p.vec_id, p.k, any_value(p.y) AS y, min({{'d': list_sum(list_transform(list_zip(p.y, b.y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': b.e}}) AS best
  FROM p JOIN b{k} b USING (k) GROUP BY p.vec_id, p.k)"""


def _moved_sql(k: int) -> str:
    return f"""
c{k} AS (SELECT k, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS y
  FROM (SELECT k, best.e AS e, i, sum(y[i])::BIGINT AS s, count(*) AS n FROM a{k}, range(1, 1000) t(i) WHERE i <= len(y) GROUP BY ALL) GROUP BY k, e),
b{k + 1} AS MATERIALIZED (SELECT k, e, coalesce(c{k}.y, b{k}.y) AS y FROM b{k} LEFT JOIN c{k} USING (k, e))"""


SQL = f"""
WITH v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, label, k::INTEGER AS k, x[(len(x) * k // {PARTS} + 1)::BIGINT:(len(x) * (k + 1) // {PARTS})::BIGINT] AS y FROM v, range({PARTS}) t(k)),
s AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v ORDER BY vec_id LIMIT {ENTRIES}),
b0 AS MATERIALIZED (SELECT p.k, s.e, p.y FROM p JOIN s USING (vec_id)),
{",".join(_round_sql(k) + "," + _moved_sql(k) for k in range(ROUNDS))},
{_round_sql(ROUNDS)},
h AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY k, e)) AS codebooks_sha256 FROM b{ROUNDS}),
r AS (SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY k) AS code, sum(best.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM r JOIN v USING (vec_id), h
"""
