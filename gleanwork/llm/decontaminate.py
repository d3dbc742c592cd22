"""Passages of test items in documents, found by an FM-index over each shard of documents.

Words are the runs of letters, digits and non-ASCII characters, A-Z lower-cased. A window is
`WINDOW` consecutive words of an item; a shorter item is one window. Every document word inside
an occurrence of a window is hit.

A shard is an Arrow batch of documents. Words that no test item has cannot be part of a match, so
the indexed text keeps the runs of known words that are as long as the shortest window, each closed
by a break. The windows are searched backwards in it, all at once, and located by sampled
positions. Nothing is shuffled. The items come in blocks of bounded size: a block is broadcast, the
documents pass once per block, and the spans are merged.

Nulls: a text or item that is null or has no word has no windows; a null item id reads "null".
Repeated item ids count once, and so do repeated items. Input columns named like a result are replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.llm.fm_index import FMIndex
from gleanwork.llm.names import quoted
from gleanwork.llm.words import NOT_ALNUM, byte_classes, chunks, words_of
from gleanwork.session import staged

WINDOW = 13
#: Characters of test items in one broadcast block.
BLOCK_CHARS = 8_000_000
#: Symbols after which a shard is closed early.
SHARD_SYMBOLS = 1 << 20

_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_RESULT = {"n_words": T.LongType(), "spans": _SPANS, "items": T.ArrayType(T.StringType())}
_ARROW = {
    "n_words": pa.int64(), "items": pa.list_(pa.string()),
    "spans": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
}


@dataclass
class Phrases:
    """The distinct windows of a block of items: per length the symbols of each, and the items it is from:
    those of window w are `numbers[first[w]:first[w + 1]]`, numbers of `item_ids`."""

    vocabulary: np.ndarray
    windows: dict[int, np.ndarray]
    items_of: dict[int, tuple[np.ndarray, np.ndarray]]
    item_ids: list[str]

    @property
    def shortest(self) -> int:
        return min(self.windows, default=0)

    def items(self, length: int, window: int) -> list[int]:
        first, numbers = self.items_of[length]
        return numbers[first[window]:first[window + 1]].tolist()


def phrases(items: Sequence[tuple[str | None, str | None]], window: int = WINDOW) -> Phrases:
    inside, values = byte_classes(NOT_ALNUM, fold=True)
    hashes, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, data, offsets in chunks(pa.array([t for _, t in items], pa.large_string())):
        w = words_of(data, offsets, inside, values)
        hashes.append(w.hashes)
        sizes.append(np.diff(w.first))
    size = np.concatenate(sizes)
    vocabulary, symbols = np.unique(np.concatenate(hashes), return_inverse=True)
    symbols = (symbols + 1).astype(np.int32)
    names = ["null" if i is None else str(i) for i, _ in items]
    ids = sorted(set(names))
    place = {x: k for k, x in enumerate(ids)}
    item = np.array([place[x] for x in names], dtype=np.int32)
    begin, length = np.cumsum(size) - size, np.minimum(size, window)
    out = Phrases(vocabulary, {}, {}, ids)
    for n in np.unique(length[length > 0]).tolist():
        rows = np.flatnonzero(length == n)
        count = size[rows] - n + 1
        grid = np.lib.stride_tricks.sliding_window_view(symbols, n)[_spread(begin[rows], count)]
        owner = np.repeat(item[rows], count)
        order = np.lexsort((owner, *grid.T[::-1]))
        grid, owner = grid[order], owner[order]
        new = np.ones(len(owner), dtype=bool)
        new[1:] = (grid[1:] != grid[:-1]).any(axis=1)
        once = new.copy()
        once[1:] |= owner[1:] != owner[:-1]
        out.windows[n] = grid[new]
        out.items_of[n] = (np.append(np.flatnonzero(new[once]), once.sum()), owner[once])
    return out


def _known_runs(ids: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of known words that are long enough, each within one text."""
    edge = np.zeros(len(ids) + 1, dtype=bool)
    edge[first] = True
    known = np.zeros(len(ids) + 2, dtype=bool)
    known[1:-1] = ids > 0
    starts = np.flatnonzero(known[1:-1] & (~known[:-2] | edge[:-1]))
    ends = np.flatnonzero(known[1:-1] & (~known[2:] | edge[1:])) + 1
    enough = ends - starts >= least
    return starts[enough], ends[enough]


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for lengths[0] numbers, then the same for the next."""
    shift = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) - np.repeat(shift - starts, lengths)


def _occurrences(text: np.ndarray, p: Phrases) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, window, position in the shard's text) of every occurrence."""
    if not len(text):
        return
    index = FMIndex(text, len(p.vocabulary))
    for length, windows in p.windows.items():
        who, low, high = index.search(windows)
        if len(who):
            yield length, np.repeat(who, high - low), index.locate(_spread(low, high - low))


class _Shard:
    """Documents of one batch; `close` searches what was gathered."""

    def __init__(self, p: Phrases, rows: int):
        self.p = p
        self.spans: list[list[tuple[int, int]]] = [[] for _ in range(rows)]
        self.items: list[set[int]] = [set() for _ in range(rows)]
        self.n_words = np.zeros(rows, dtype=np.int64)
        self.clear()

    def clear(self) -> None:
        self.texts, self.rows, self.at, self.size = [], [], [], 0

    def add(self, row: int, ids: np.ndarray, first: np.ndarray) -> None:
        starts, ends = _known_runs(ids, first, self.p.shortest)
        if not len(starts):
            return
        lengths = ends - starts
        words = _spread(starts, lengths)
        slots = _spread(np.cumsum(lengths + 1) - lengths - 1, lengths)
        text = np.zeros(int((lengths + 1).sum()), dtype=np.int64)
        owner, at = text.copy(), text.copy()
        mine = np.searchsorted(first, words, "right") - 1
        text[slots], owner[slots], at[slots] = ids[words], mine + row, words - first[mine]
        self.texts.append(text)
        self.rows.append(owner)
        self.at.append(at)
        self.size += len(text)
        if self.size >= SHARD_SYMBOLS:
            self.close()

    def close(self) -> None:
        if not self.size:
            return
        rows, at = np.concatenate(self.rows), np.concatenate(self.at)
        for length, window, position in _occurrences(np.concatenate(self.texts), self.p):
            owner, start = rows[position], at[position]
            for r, s in np.unique(np.stack([owner, start]), axis=1).T.tolist():
                self.spans[r].append((s, s + length))
            for r, w in np.unique(np.stack([owner, window]), axis=1).T.tolist():
                self.items[r].update(self.p.items(length, w))
        self.clear()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan_batch(texts: pa.Array, p: Phrases) -> _Shard:
    inside, values = byte_classes(NOT_ALNUM, fold=True)
    shard = _Shard(p, len(texts))
    for row, to, data, offsets in chunks(texts):
        w = words_of(data, offsets, inside, values)
        shard.n_words[row:to] = np.diff(w.first)
        if len(p.vocabulary):
            at = np.minimum(np.searchsorted(p.vocabulary, w.hashes), len(p.vocabulary) - 1)
            shard.add(row, np.where(p.vocabulary[at] == w.hashes, at + 1, 0), w.first)
    shard.close()
    return shard


def scan(
    docs: DataFrame, benchmark: DataFrame, keep: Sequence[str], text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The columns `keep` of every document with `n_words`, `spans` (merged ranges of hit words,
    end exclusive) and `items` (the sorted ids of the items that occur)."""
    keep = [c for c in keep if c not in _RESULT]
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")).distinct()
    size = items.agg(F.sum(F.length("t")).alias("n")).first()["n"]
    blocks = max(1, math.ceil((size or 0) / block_chars))
    own = [f"own_{i}" for i in range(len(keep))]
    out = docs.select(*[quoted(c).alias(v) for c, v in zip(keep, own, strict=True)], quoted(text).alias("text"))
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).collect()
        block = docs.sparkSession.sparkContext.broadcast(vars(phrases([(r["i"], r["t"]) for r in rows], window)))
        if k:
            out = staged(out, "decontaminate")
        out = _pass(out, own, block, first=k == 0)
    return out.select(*[F.col(v).alias(c) for c, v in zip(keep, own, strict=True)], *_RESULT)


def _pass(docs: DataFrame, keep: Sequence[str], block, first: bool) -> DataFrame:
    fields = [docs.schema[c] for c in [*keep, "text"]]
    schema = T.StructType([*fields, *[T.StructField(n, t) for n, t in _RESULT.items()]])
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = Phrases(**block.value)
            shard = _scan_batch(batch.column("text"), p)
            items = [[p.item_ids[i] for i in x] for x in shard.items]
            spans = shard.spans
            if not first:
                spans = [[(s["start"], s["end"]) for s in old] + new for old, new in zip(batch.column("spans").to_pylist(), spans, strict=True)]
                items = [old + new for old, new in zip(batch.column("items").to_pylist(), items, strict=True)]
            result = {
                "n_words": pa.array(shard.n_words),
                "spans": pa.array([[{"start": a, "end": b} for a, b in merged(x)] for x in spans], _ARROW["spans"]),
                "items": pa.array([sorted(set(x)) for x in items], _ARROW["items"]),
            }
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *result.values()], names=[*names, *result])

    return docs.mapInArrow(run, schema)


def n_hit() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contaminated(share: int = 20) -> Column:
    """At least one word in `share` is hit."""
    return (n_hit() > 0) & (n_hit() * share >= F.col("n_words"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns unchanged."""
    own = {c: f"kept_{i}" for i, c in enumerate(docs.columns)}
    marked = scan(docs.toDF(*own.values()), benchmark, list(own.values()), text=own["text"])
    return marked.filter(~contaminated()).select(*[F.col(v).alias(c) for c, v in own.items()])

