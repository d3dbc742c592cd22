"""Remove passages that a document with a smaller id has too, by prefix-partitioned suffix trees.

Every position of a text starts a suffix, of which the first `WINDOW` words matter: a window that
starts in a document with a smaller id as well is removed. Suffixes are split into groups by a prefix
of their words. How many words the prefix takes varies: the fewest (of `PREFIX_LENGTHS`) at which
the hashed prefix has at most a part of a group's capacity, counted over the whole corpus. A group
holds whole subtrees and fits in memory.

Hot prefixes: within a chunk of documents a window is posted once, for its smallest document; the
others in the chunk are settled on the spot. So a group has one posting per chunk and window, however
many copies there are.

A group sorts its suffixes by a 56-bit hash of the path from the root to depth `WINDOW` (the group adds
its own bits, and groups do not grow with the corpus). Runs of equal hashes are the leaves of one deep
internal node: the longest repeats are runs of such nodes, merged per document at the end. All
postings but those of the node's smallest document are answered with a removal.

Texts shuffle once, to meet their removals; postings shuffle as packed blocks of about 9 bytes each.

Nulls: a null text has no words. A document without an id counts as larger than all, and not as
smaller than another one without. Rows with equal id and text are treated alike. Texts shorter than a window lose nothing.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.llm.names import quoted
from gleanwork.llm.words import BLANKS, byte_classes, chunks, constants, mix, words_of

WINDOW = 13
PREFIX_LENGTHS = (1, 2, 4, 8, 13)
#: Suffixes a group should hold.
GROUP_SUFFIXES = 1 << 21
#: Bytes of text whose windows are settled together before anything is posted.
CHUNK_BYTES = 8 << 20
_PREFIX_BITS = 14
_NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Split:
    """Which prefix lengths suffice, by hashed prefix, and how many groups there are."""

    enough: np.ndarray
    groups: int


def prefix_hashes(hashes: np.ndarray) -> Iterator[np.ndarray]:
    """For each prefix length the hash of the prefix at each window's start."""
    n = len(hashes) - WINDOW + 1
    total, done = np.zeros(max(n, 0), dtype=np.uint64), 0
    c = constants(23, WINDOW)
    with np.errstate(over="ignore"):
        for length in PREFIX_LENGTHS:
            for i in range(done, length):
                total = total + hashes[i:n + i] * c[i]
            done = length
            yield mix(total + np.uint64(length))


def _whole_windows(first: np.ndarray, n: int) -> np.ndarray:
    """Positions whose window lies within one text."""
    size = np.diff(first)
    inside = np.repeat(first[1:], size)[:n] - np.arange(n)
    return np.flatnonzero(inside >= WINDOW)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inside, values = byte_classes(BLANKS, fold=False)
    counts = np.zeros((len(PREFIX_LENGTHS), 1 << _PREFIX_BITS), dtype=np.int64)
    for batch in batches:
        for _, _, data, offsets in chunks(batch.column(0)):
            w = words_of(data, offsets, inside, values)
            at = _whole_windows(w.first, max(0, len(w.hashes) - WINDOW + 1))
            for k, h in enumerate(prefix_hashes(w.hashes)):
                counts[k] += np.bincount((h[at] >> np.uint64(64 - _PREFIX_BITS)).astype(np.int64), minlength=1 << _PREFIX_BITS)
    flat = counts.ravel()
    slots = np.flatnonzero(flat)
    yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(flat[slots])], names=["slot", "n"])


def split_of(docs: DataFrame, text: str, capacity: int) -> Split:
    """Counts of hashed prefixes over all documents: a table of fixed size, whatever the corpus."""
    found = docs.select(F.col(text).alias("text")).mapInArrow(_counted, "slot long, n long")
    counts = np.zeros(len(PREFIX_LENGTHS) << _PREFIX_BITS, dtype=np.int64)
    for row in found.groupBy("slot").agg(F.sum("n").alias("n")).collect():
        counts[row["slot"]] = row["n"]
    counts = counts.reshape(len(PREFIX_LENGTHS), -1)
    groups = max(1, math.ceil(int(counts[0].sum()) / capacity))
    # Small against a group, unless no longer prefix is left.
    enough = counts <= max(1, capacity // 8)
    enough[-1] = True
    return Split(enough, groups)


def _planes(x: np.ndarray) -> bytes:
    """The bytes of the numbers, all lowest ones first: small numbers then compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _from_planes(b: bytes, dtype: type) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(b, np.uint8).reshape(-1, len(b) // width) if b else np.zeros((width, 0), np.uint8)
    if planes.shape[0] < width:
        planes = np.concatenate([planes, np.zeros((width - planes.shape[0], planes.shape[1]), np.uint8)])
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _pack56(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, 1:]).tobytes()


def _unpack56(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 7, 8), dtype=np.uint8)
    out[:, 1:] = np.frombuffer(b, np.uint8).reshape(-1, 7)
    return out.view(np.uint64).ravel()


_BLOCK = T.StructType([
    T.StructField("to", T.IntegerType()), T.StructField("settled", T.BooleanType()), T.StructField("keys", T.BinaryType()),
    T.StructField("gaps", T.BinaryType()), T.StructField("ids", T.BinaryType()), T.StructField("texts", T.BinaryType()),
    T.StructField("first", T.BinaryType()),
])
_BLOCK_ARROW = pa.schema([
    ("to", pa.int32()), ("settled", pa.bool_()), ("keys", pa.binary()), ("gaps", pa.binary()), ("ids", pa.binary()),
    ("texts", pa.binary()), ("first", pa.binary()),
])


def _block(to: int, settled: bool, keys: bytes, at: np.ndarray, ids: np.ndarray, texts: np.ndarray, first: np.ndarray) -> dict:
    """Positions `at` in a chunk (ascending) with the documents that have any of them."""
    doc = np.searchsorted(first, at, "right") - 1
    used = np.unique(doc)
    return {
        "to": to, "settled": settled, "keys": keys, "gaps": _planes(np.diff(at, prepend=0).astype(np.uint32)),
        "ids": ids[used].tobytes(), "texts": texts[used].tobytes(), "first": first[used].astype(np.uint32).tobytes(),
    }


def _unblock(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(id, text, word position) per posting, and its number among the block's documents."""
    at = np.cumsum(_from_planes(row["gaps"], np.uint32).astype(np.int64))
    first = np.frombuffer(row["first"], np.uint32).astype(np.int64)
    doc = np.searchsorted(first, at, "right") - 1
    return np.frombuffer(row["ids"], np.int64)[doc], np.frombuffer(row["texts"], np.int64)[doc], at - first[doc], doc


def _by_group(order_key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(order_key, kind="stable")
    cuts = np.flatnonzero(np.diff(order_key[order], prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        yield int(order_key[order[a]]), order[a:b]


def _postings(split) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, values = byte_classes(BLANKS, fold=False)
        s = Split(**split.value)
        for batch in batches:
            ids, fps = (np.asarray(batch.column(c).fill_null(_NO_ID), dtype=np.int64) for c in ("id", "fp"))
            held, size, since = [], 0, 0
            for row, to, data, offsets in chunks(batch.column("text")):
                w = words_of(data, offsets, inside, values)
                held.append((w.hashes, np.diff(w.first)))
                size += len(data)
                if size >= CHUNK_BYTES or to == len(batch):
                    hashes = np.concatenate([h for h, _ in held])
                    first = np.concatenate([[0], np.cumsum(np.concatenate([n for _, n in held]))])
                    for block in _chunk(hashes, first, s, ids[since:to], fps[since:to]):
                        yield pa.RecordBatch.from_pylist([block], schema=_BLOCK_ARROW)
                    held, size, since = [], 0, to
    return run


def _chunk(hashes: np.ndarray, first: np.ndarray, s: Split, ids: np.ndarray, texts: np.ndarray) -> Iterator[dict]:
    at = _whole_windows(first, max(0, len(hashes) - WINDOW + 1))
    if not len(at):
        return
    group = np.full(len(at), -1, dtype=np.int64)
    for k, h in enumerate(prefix_hashes(hashes)):
        h = h[at]
        use = (group < 0) & s.enough[k][(h >> np.uint64(64 - _PREFIX_BITS)).astype(np.int64)]
        group[use] = (mix(h[use] ^ np.uint64(0x51)) % np.uint64(s.groups)).astype(np.int64)
    key = h  # of the whole window
    owner = ids[np.searchsorted(first, at, "right") - 1]
    # Within the chunk the window is posted for its smallest document; others are settled.
    order = np.lexsort((at, owner, key))
    new = np.flatnonzero(np.diff(key[order], prepend=~key[order[:1]]) != 0)
    run = np.repeat(new, np.diff([*new, len(order)]))
    later = owner[order] > owner[order[run]]
    settled = np.sort(order[later])
    keep = np.sort(order[~later])
    if len(settled):
        # Sent along with the postings of some group; they only need to reach their documents.
        yield _block(int(key[settled[0]] % np.uint64(s.groups)), True, b"", at[settled], ids, texts, first[:-1])
    for g, x in _by_group(group[keep]):
        x = keep[x]
        yield _block(g, False, _pack56(key[x]), at[x], ids, texts, first[:-1])


_REPLY = T.StructType([
    T.StructField("to", T.IntegerType()), T.StructField("ids", T.BinaryType()), T.StructField("texts", T.BinaryType()),
    T.StructField("counts", T.BinaryType()), T.StructField("at", T.BinaryType()),
])
_REPLY_ARROW = pa.schema([("to", pa.int32()), ("ids", pa.binary()), ("texts", pa.binary()), ("counts", pa.binary()), ("at", pa.binary())])


def _slot(ids: np.ndarray, texts: np.ndarray, slots: int) -> np.ndarray:
    """As `pmod(id ^ text, slots)`: copies of one text have different ids and so spread."""
    return (ids ^ texts) % slots


def _replies(ids: np.ndarray, texts: np.ndarray, at: np.ndarray, slots: int) -> Iterator[dict]:
    """Removals packed by the partition their documents go to."""
    order = np.lexsort((at, texts, ids))
    ids, texts, at = ids[order], texts[order], at[order]
    for slot, x in _by_group(_slot(ids, texts, slots)):
        a, b = ids[x], texts[x]
        new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        yield {
            "to": slot, "ids": a[new].tobytes(), "texts": b[new].tobytes(),
            "counts": np.diff([*new, len(x)]).astype(np.uint32).tobytes(), "at": _planes(at[x].astype(np.uint32)),
        }


def _answers(slots: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["settled"]:
                    ids, texts, at, _ = _unblock(row)
                    yield pa.RecordBatch.from_pylist(list(_replies(ids, texts, at, slots)), schema=_REPLY_ARROW)
                else:
                    groups.setdefault(row["to"], []).append(row)
        while groups:
            rows = groups.popitem()[1]
            key = np.concatenate([_unpack56(r["keys"]) for r in rows])
            parts = [_unblock(r)[:3] for r in rows]
            ids, texts, at = (np.concatenate([p[i] for p in parts]) for i in range(3))
            order = np.lexsort((ids, key))
            key, ids = key[order], ids[order]
            fresh = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            least = np.repeat(ids[fresh], np.diff([*fresh, len(key)]))
            gone = ids > least
            if gone.any():
                back = order[gone]
                yield pa.RecordBatch.from_pylist(list(_replies(ids[gone], texts[back], at[back], slots)), schema=_REPLY_ARROW)
    return run


def _removed(words: list[bytes], at: np.ndarray) -> np.ndarray:
    """Which words the windows starting `at` cover."""
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def _finished(keep: Sequence[str], schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:  # removals come before documents
            is_doc = batch.column("__is_doc").to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(~is_doc).tolist():
                row = {c: batch.column(f"__{c}")[i].as_py() for c in ("ids", "texts", "counts", "at")}
                ids, texts = (np.frombuffer(row[c], np.int64).tolist() for c in ("ids", "texts"))
                at = np.split(_from_planes(row["at"], np.uint32).astype(np.int64), np.cumsum(np.frombuffer(row["counts"], np.uint32))[:-1])
                for key, x in zip(zip(ids, texts, strict=True), at, strict=True):
                    gone.setdefault(key, []).append(x)
            docs = batch.filter(pa.array(is_doc))
            if not len(docs):
                continue
            out = {"n_words": [], "n_removed": [], "kept": [], "spans": []}
            for i, f, t in zip(docs.column("__id").to_pylist(), docs.column("__fp").to_pylist(), docs.column("__text").to_pylist(), strict=True):
                words = (t or "").encode().split()
                at = gone.get((i, f))
                drop = _removed(words, np.concatenate(at)) if at else np.zeros(len(words), dtype=bool)
                edge = np.flatnonzero(np.diff(drop.astype(np.int8), prepend=0, append=0))
                out["n_words"].append(len(words))
                out["n_removed"].append(int(drop.sum()))
                kept = [words[k] for k in np.flatnonzero(~drop)] if at else words
                out["kept"].append(b" ".join(kept).decode())
                out["spans"].append([{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()])
            columns = [docs.column(c) for c in keep] + [pa.array(v, schema.field(c).type) for c, v in out.items()]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *out])
    return run


RESULT = ("n_words", "n_removed", "kept", "spans")
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def remove_repeats(docs: DataFrame, keep: Sequence[str], key: str = "doc_id", text: str = "text", capacity: int = GROUP_SUFFIXES) -> DataFrame:
    """The columns `keep` of every document with `n_words`, `n_removed`, `kept` (the words left,
    joined by blanks) and `spans` (the removed ranges of words, end exclusive)."""
    spark = docs.sparkSession
    keep = [c for c in keep if c not in RESULT]
    own = [f"own_{i}" for i in range(len(keep))]
    split = split_of(docs, text, capacity)
    shared = spark.sparkContext.broadcast(vars(split))
    slots = max(split.groups, int(spark.conf.get("spark.sql.shuffle.partitions")))
    slim = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("fp"), F.col(text).alias("text"))
    posted = slim.mapInArrow(_postings(shared), _BLOCK)
    replies = posted.repartitionById(slots, F.col("to")).mapInArrow(_answers(slots), _REPLY)
    bare = [F.lit(None).cast("binary").alias(f"__{c}") for c in ("ids", "texts", "counts", "at")]
    rows = docs.select(
        F.lit(True).alias("__is_doc"), F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("__id"),
        F.xxhash64(F.col(text)).alias("__fp"), F.col(text).alias("__text"), *bare, *[quoted(c).alias(v) for c, v in zip(keep, own, strict=True)])
    slot = F.pmod(F.col("__id").bitwiseXOR(F.col("__fp")), F.lit(slots)).cast("int")
    rows = rows.select(slot.alias("__to"), *rows.columns)
    gone = replies.select(F.col("to").alias("__to"), F.lit(False).alias("__is_doc"), *[F.col(c).alias(f"__{c}") for c in ("ids", "texts", "counts", "at")])
    met = rows.unionByName(gone, allowMissingColumns=True).repartitionById(slots, F.col("__to")).sortWithinPartitions("__is_doc")
    schema = T.StructType([*[T.StructField(v, docs.schema[c].dataType) for c, v in zip(keep, own, strict=True)], T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()), T.StructField("spans", _SPANS)])
    arrow = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
    return met.mapInArrow(_finished(own, arrow), schema).select(*[F.col(v).alias(c) for c, v in zip(keep, own, strict=True)], *RESULT)
