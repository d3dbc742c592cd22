"""Quality of documents: random-indexing word vectors, pooled, and a two-layer network.

Words are split at blanks, A-Z folded. Beside its words a text has as many marks: of a word of up to `SHORT` bytes the
word, of a longer one its shape (runs of letters, capitals, digits and each sign, as in `A-a.`), and of one that repeats the word
before or the one before that a sign for it. Words are hashed to 2^`BITS` buckets, marks to 2^`MARK_BITS` others. Every bucket
has a fixed sparse random vector; a bucket's word vector is the sum of the random vectors of itself and of the words (for a mark, marks) up to
`REACH` places away, over all documents. A document is the mean of its words' unit vectors and that of its marks',
each plainly and weighted by rarity. The network is fitted with numpy on at most `SAMPLE` labelled rows (the
smallest by hash of id); a fifth of them is held back to fit the temperature of its
probabilities.

Null and empty texts have the zero vector and get the network's score for it. Rows with a null label, and rows whose id is null, are
not learnt from; without two labels every score is the share of ones (0.5 without labels). Repeated ids take
each label once. Empty table: empty result. Columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.llm.names import quoted
from gleanwork.llm.words import BLANKS, byte_classes, chunks, constants, mix, words_of
from gleanwork.session import staged

BITS, MARK_BITS, DIMENSIONS, SPARSE, REACH, SHORT = 16, 14, 64, 4, 2, 4
BUCKETS = (1 << BITS) + (1 << MARK_BITS)
#: Numbers that describe a document.
WIDTH = 4 * DIMENSIONS
SAMPLE = 20_000
HIDDEN, EPOCHS, BATCH, STEP, DECAY = 32, 60, 256, 3e-3, 1e-4
RARE = 1e-3
_BLOCKS = 256
#: Stand for a word that repeats the one before, or the one before that.
_AGAIN = constants(131, 2)


def _shapes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[97:123] = table[128:] = ord("a")
    table[65:91] = ord("A")
    table[48:58] = ord("0")
    table[list(BLANKS)] = 32
    return table


def buckets_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every word, bucket of its mark, first word of every text)."""
    w = words_of(data, offsets, *byte_classes(BLANKS, fold=True))
    shape = _shapes()[data]
    fresh = np.ones(len(shape), dtype=bool)
    fresh[1:] = shape[1:] != shape[:-1]
    fresh[offsets[offsets < len(shape)]] = True
    place = np.concatenate([[0], np.cumsum(fresh)])
    s = words_of(shape[fresh], place[offsets], *byte_classes(BLANKS, fold=False))
    # A short word is itself.
    h = np.where(w.ends - w.starts <= SHORT, w.hashes, mix(s.hashes))
    owner = w.owner()
    for back in (1, 2):
        again = back + np.flatnonzero((w.hashes[back:] == w.hashes[:-back]) & (owner[back:] == owner[:-back]))
        h[again] = _AGAIN[back - 1]
    marks = (h >> np.uint64(64 - MARK_BITS)).astype(np.int64) + (1 << BITS)
    return (w.hashes >> np.uint64(64 - BITS)).astype(np.int64), marks, w.first


def random_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Per bucket the places and signs of its random vector."""
    x = constants(97, BUCKETS * SPARSE).reshape(BUCKETS, SPARSE)
    return (x >> np.uint64(40)).astype(np.int64) % DIMENSIONS, np.where(x & np.uint64(2), 1, -1).astype(np.int64)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, signs = random_vectors()
    total, seen = np.zeros(BUCKETS * DIMENSIONS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for _, _, data, offsets in chunks(batch.column(0)):
            words, marks, first = buckets_of(data, offsets)
            owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
            for b in (words, marks):
                seen += np.bincount(b, minlength=BUCKETS)
                for d in range(1, REACH + 1):
                    if len(b) <= d:
                        continue
                    near = np.flatnonzero(owner[d:] == owner[:-d])
                    for me, other in ((b[near], b[near + d]), (b[near + d], b[near])):
                        np.add.at(total, (me[:, None] * DIMENSIONS + places[other]).ravel(), signs[other].ravel())
    parts = np.concatenate([total.reshape(_BLOCKS, -1), seen.reshape(_BLOCKS, -1)], axis=1)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(_BLOCKS)), pa.array([p.tobytes() for p in parts], pa.binary())], names=["block", "sums"])


def added(key: tuple, rows: pa.Table) -> pa.Table:
    """Sum of a block's arrays of long numbers."""
    total = 0
    for b in rows["sums"]:
        total = total + np.frombuffer(b.as_py(), np.int64)
    return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})


def units(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The unit word vectors of a block and how often its buckets were seen, from the sums of all tasks, taken one after the other."""
    width, block = BUCKETS // _BLOCKS, key[0].as_py()
    x = np.zeros(width * (DIMENSIONS + 1), dtype=np.int64)
    for rows in parts:
        for b in rows.column("sums"):
            x += np.frombuffer(b.as_buffer(), np.int64)
    total, seen = x[:-width].reshape(width, DIMENSIONS).astype(np.float64), x[-width:].astype(np.float64)
    places, signs = (v[block * width:(block + 1) * width] for v in random_vectors())
    for place, sign in zip(places.T, signs.T, strict=True):
        total[np.arange(width), place] += sign * seen
    unit = (total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "unit": pa.array([unit.tobytes()], pa.binary()), "seen": pa.array([seen.tobytes()], pa.binary())})


def word_vectors(docs: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray]:
    """(unit word vectors, rarity weights) per bucket, from all documents; of fixed size (21 MB)."""
    sums = docs.select(F.col(text).alias("text")).mapInArrow(_summed, "block long, sums binary")
    rows = sums.groupBy("block").applyInArrow(units, "block long, unit binary, seen binary").toArrow()
    width = BUCKETS // _BLOCKS
    vectors, seen = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32), np.zeros(BUCKETS)
    for block, unit, n in zip(rows["block"].to_pylist(), rows["unit"], rows["seen"], strict=True):
        at = slice(block * width, (block + 1) * width)
        vectors[at], seen[at] = np.frombuffer(unit.as_buffer(), np.float32).reshape(width, DIMENSIONS), np.frombuffer(n.as_buffer(), np.float64)
    # As many marks as words.
    share = seen / max(1.0, seen.sum() / 2)
    return vectors, (RARE / (RARE + share)).astype(np.float32)


def pooled(text: pa.Array, vectors: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """One row per text: the means of its words' and of its marks' vectors, plain and weighted by rarity."""
    out = np.zeros((len(text), WIDTH), dtype=np.float32)
    for row, to, data, offsets in chunks(text):
        words, marks, first = buckets_of(data, offsets)
        n = np.diff(first)
        full = np.flatnonzero(n > 0)
        if len(full):
            for at, b in ((0, words), (2 * DIMENSIONS, marks)):
                weights = np.stack([np.ones(len(b), np.float32), rarity[b]])
                weights /= np.repeat(np.add.reduceat(weights, first[:-1][full], axis=1), n[full], axis=1)
                # Text by text, for vectors that stay in the processor's cache.
                for i in full:
                    mine = slice(first[i], first[i + 1])
                    out[row + i, at:at + 2 * DIMENSIONS] = (weights[:, mine] @ vectors[b[mine]]).ravel()
    return out


def _sampled(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pooled(batch.column("text"), *shared.value)
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), lists], names=["id", "y", "x"])
    return run


def _forward(x: np.ndarray, net: dict) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(((x - net["mean"]) / net["scale"]) @ net["w1"] + net["b1"])
    return hidden, hidden @ net["w2"] + net["b2"]


def probability(x: np.ndarray, net: dict) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_forward(x, net)[1] / net["temperature"], -35, 35)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def train(x: np.ndarray, y: np.ndarray, seed: int = 3) -> dict:
    rng = np.random.default_rng(seed)
    net = {"mean": x.mean(axis=0) if len(x) else 0.0, "scale": (x.std(axis=0) if len(x) else 1.0) + 1e-6, "temperature": 1.0,
           "w1": rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), "b1": np.zeros(HIDDEN), "w2": np.zeros(HIDDEN), "b2": 0.0}
    if not 0 < y.sum() < len(y):
        net["b2"] = float(np.clip(np.log((y.sum() + 1e-9) / (len(y) - y.sum() + 1e-9)), -20, 20)) if len(y) else 0.0
        return net
    order = rng.permutation(len(x))
    held, used = order[: len(x) // 5], order[len(x) // 5:]
    names = ("w1", "b1", "w2", "b2")
    first, second, t = {n: 0.0 for n in names}, {n: 0.0 for n in names}, 0
    for _ in range(EPOCHS):
        rng.shuffle(used)
        for k in range(0, len(used), BATCH):
            rows, t = used[k:k + BATCH], t + 1
            hidden, z = _forward(x[rows], net)
            g = (1 / (1 + np.exp(-z)) - y[rows]) / len(rows)
            back = g[:, None] * net["w2"] * (1 - hidden ** 2)
            grads = {"w1": ((x[rows] - net["mean"]) / net["scale"]).T @ back + DECAY * net["w1"], "b1": back.sum(axis=0), "w2": hidden.T @ g + DECAY * net["w2"], "b2": g.sum()}
            for n in names:
                first[n] = 0.9 * first[n] + 0.1 * grads[n]
                second[n] = 0.999 * second[n] + 0.001 * grads[n] ** 2
                net[n] = net[n] - STEP * (first[n] / (1 - 0.9 ** t)) / (np.sqrt(second[n] / (1 - 0.999 ** t)) + 1e-8)
    if len(held):
        z = _forward(x[held], net)[1]
        net["temperature"] = float(min(np.geomspace(0.25, 8, 61), key=lambda s: _loss(z / s, y[held])))
    return net


def _scored(vectors, net) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pooled(batch.column("__text"), *vectors.value).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(probability(x, net.value))], names=[*batch.schema.names[:-1], "score"])
    return run


def held_out(key: Column, folds: int, fold: int) -> Column:
    """The rows kept for testing: crc32 of the id as text leaves `fold`; false without an id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_rows(labels: DataFrame, key: str, label: str, folds: int, fold: int, sample: int) -> DataFrame:
    """(key, y): at most `sample` labelled rows outside the held-out ones, the same for any run."""
    rows = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key), folds, fold))
    rows = rows.select(F.col(key).alias("__labelled"), F.col(label).cast("int").alias("y")).distinct()
    return rows.orderBy(F.xxhash64("__labelled"), "__labelled", "y").limit(sample)


def _fitted(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, folds: int, fold: int, sample: int) -> tuple[Broadcast, Broadcast]:
    """The word vectors and the trained network."""
    context = docs.sparkSession.sparkContext
    vectors = context.broadcast(word_vectors(docs, text))
    # At most `sample` rows.
    wanted = F.broadcast(training_rows(labels, key, label, folds, fold, sample))
    known = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(wanted, F.col("k") == F.col("__labelled"))
    known = known.select(F.col("__labelled").alias("id"), "y", "text").mapInArrow(_sampled(vectors), f"id {wanted.schema['__labelled'].dataType.simpleString()}, y int, x array<float>")
    known = known.orderBy(F.xxhash64("id"), "id", "y").limit(sample).toArrow()
    x, y = known["x"].combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(known), WIDTH), known["y"].to_numpy().astype(np.float64)
    del known
    net = context.broadcast(train(x, y))
    del x, y
    # Arrow keeps what the tables above held for its next ones.
    pa.default_memory_pool().release_unused()
    return vectors, net


def _applied(docs: DataFrame, keep: Sequence[str], key: str, text: str, folds: int, fold: int, vectors: Broadcast, net: Broadcast) -> DataFrame:
    own = {c: f"own_{i}" for i, c in enumerate(keep) if c not in ("held_out", "score", "predicted")}
    rows = docs.select(*[quoted(c).alias(v) for c, v in own.items()], F.col(key).alias("__key"), F.col(text).alias("__text"))
    out = rows.mapInArrow(_scored(vectors, net), T.StructType([*rows.schema.fields[:-1], T.StructField("score", T.DoubleType())]))
    return out.select(
        *[F.col(v).alias(c) for c, v in own.items()], held_out(F.col("__key"), folds, fold).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def score_quality(
    docs: DataFrame, labels: DataFrame, keep: Sequence[str], key: str = "doc_id", text: str = "text", label: str = "quality",
    folds: int = 3, fold: int = 1, sample: int = SAMPLE,
) -> DataFrame:
    """The columns `keep` of every document with `held_out`, `score` and `predicted`."""
    return _applied(docs, keep, key, text, folds, fold, *_fitted(docs, labels, key, text, label, folds, fold, sample))


def keep_good(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 3, fold: int = 1, sample: int = SAMPLE,
) -> DataFrame:
    """The documents with a score of at least 0.5, with all their columns unchanged, from a written table: the driver holds the
    word vectors as long as a plan may need them, so they are destroyed when all is scored."""
    own = {c: f"__own_{i}" for i, c in enumerate(docs.columns)}
    docs, labels, key, text = docs.toDF(*own.values()), labels.withColumnRenamed(key, own[key]), own[key], own[text]
    shared = _fitted(docs, labels, key, text, label, folds, fold, sample)
    scored = _applied(docs, list(own.values()), key, text, folds, fold, *shared)
    kept = staged(scored.filter("predicted = 1").select(*own.values()), "good")
    for model in shared:
        model.destroy()
    return kept.toDF(*own)
