"""Whole Arrow batches of texts cut into hashed words with numpy, without a Python step per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 20
#: Bytes whose words are hashed at once.
BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15


@dataclass
class Words:
    """Words of consecutive texts: `first[i]:first[i + 1]` are those of text i."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(seed: int, n: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)


def byte_classes(separators: bytes, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and the value of each byte; `fold` reads A-Z as a-z."""
    inside = np.ones(256, dtype=bool)
    inside[list(separators)] = False
    values = constants(7, 256)
    if fold:
        inside[65:91], values[65:91] = inside[97:123], values[97:123]
    return inside, values


BLANKS = bytes([32, *range(9, 14)])
NOT_ALNUM = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def _powers(base: int, n: int) -> np.ndarray:
    up = np.full(n, base, dtype=np.uint64)
    up[:1] = 1
    return np.multiply.accumulate(up)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, offsets) of consecutive rows holding about `limit` bytes; a null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, to, data[offsets[row]:offsets[to]], offsets[row:to + 1] - offsets[row]
        row = to


def words_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, values: np.ndarray) -> Words:
    """Words are the longest runs of `inside` bytes within a text."""
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    word = np.zeros(len(data) + 2, dtype=bool)
    word[1:-1] = inside[data]
    here = word[1:-1]
    starts = np.flatnonzero(here & (~word[:-2] | edge[:-1]))
    ends = np.flatnonzero(here & (~word[2:] | edge[1:])) + 1
    return Words(word_hashes(data, starts, ends, values), np.searchsorted(starts, offsets), starts, ends)


@cache
def _scales() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse for the bytes of a block."""
    return _powers(_BASE, BLOCK_BYTES), _powers(pow(_BASE, -1, 1 << 64), BLOCK_BYTES)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the bytes `starts[i]:ends[i]`, which ascend and do not overlap.

    Consecutive words are taken together as long as they reach over `BLOCK_BYTES` at most; a longer word is
    added up block by block. So memory beside the result stays the same however long the text is.
    """
    out = np.zeros(len(starts), dtype=np.uint64)
    up, down = _scales()
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            low = int(starts[i])
            to = int(np.searchsorted(ends, low + BLOCK_BYTES, "right"))
            if to > i:
                high = int(ends[to - 1])
                total = np.zeros(high - low + 1, dtype=np.uint64)
                np.cumsum(values[data[low:high]] * up[:high - low], out=total[1:])
                out[i:to] = (total[ends[i:to] - low] - total[starts[i:to] - low]) * down[starts[i:to] - low]
                i = to
                continue
            for n, at in enumerate(range(low, int(ends[i]), BLOCK_BYTES)):
                part = values[data[at:min(at + BLOCK_BYTES, int(ends[i]))]]
                out[i] += (part * up[:len(part)]).sum(dtype=np.uint64) * np.uint64(pow(_BASE, n * BLOCK_BYTES, 1 << 64))
            i += 1
        return mix(out)


def grams(hashes: np.ndarray, n: int, seed: int = 11) -> np.ndarray:
    """Hash of the n words from each position on; shorter by n - 1 than its input."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
        for i, c in enumerate(constants(seed, n)):
            total += hashes[i:len(hashes) - n + 1 + i] * c
        return mix(total)
