"""License notices in whole texts, also with a few edits in them.

A text is read as its words in lower case (A-Z folded), one blank between them. A notice of m characters
may differ by k = m / 10 edits, at most `MOST_EDITS`; an edit inserts, deletes or replaces a
character. Cut into k + 1 pieces, at least one piece of it is unchanged wherever it occurs (pigeonhole), so one
automaton of all pieces finds every candidate. The part of the text that the candidate can cover is then searched by
the `regex` library with that bound of edits, between whole words, for its best match. Of matches of one notice
that overlap the one with fewer edits stays, the earlier one on a tie. Base phrases are pieces of their own, without
edits, and are counted at every place.

A text is read in pieces of about `PIECE` bytes cut between words, and what a notice may still reach
is carried over, so the memory of a task does not grow with its longest text, only with its longest word and
its number of matches.

Null text: empty. Empty text: no words, empty lists, score 0. One row per given row, repeated rows and null ids
included; other columns keep their values, those named like a result are replaced by it. Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.llm.names import quoted

# Phrases that count as such, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Notices that may hold edits, and their labels.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache license": "apache",
    "licensed under the apache license version 2 0": "apache",
    "gnu general public license": "gpl",
    "this program is free software you can redistribute it and or modify it": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "boost",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "isc license": "isc",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "reserved",
}
MOST_EDITS = 4
#: Characters of a notice for each edit that it may hold.
CHARS_PER_EDIT = 10
PIECE = 1 << 20

_WORD_BYTE = np.ones(256, dtype=bool)
_WORD_BYTE[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
_WORD_BYTE[0x41:0x5B] = True
#: Bytes outside words become blanks, A-Z become a-z.
_READ = bytes((b + 32 if 0x41 <= b < 0x5B else b) if _WORD_BYTE[b] else 32 for b in range(256))


@dataclass(frozen=True)
class Place:
    """An occurrence in words, end exclusive; `at` and `to` in characters of the text as read."""

    notice: str
    at: int
    to: int
    edits: int
    start: int = 0
    end: int = 0


def allowed(notice: str) -> int:
    return min(MOST_EDITS, len(notice) // CHARS_PER_EDIT)


def seeds(notice: str, edits: int) -> list[tuple[int, str]]:
    """edits + 1 pieces of nearly equal length, with their offsets."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Finder:
    def __init__(self, notices: Sequence[str], phrases: Sequence[str]):
        self.edits = {n: allowed(n) for n in notices}
        self.patterns = {n: regex.compile(f"(?<= )(?:{regex.escape(n)}){{e<={k}}}(?= )", regex.BESTMATCH) for n, k in self.edits.items()}
        wanted: dict[str, list[tuple[str | None, str | None, int]]] = {}
        for n, k in self.edits.items():
            for offset, seed in seeds(n, k):
                wanted.setdefault(seed, []).append((n, None, offset))
        for p in phrases:
            wanted.setdefault(f" {p} ", []).append((None, p, 0))
        self.automaton = ahocorasick.Automaton()
        for seed, uses in wanted.items():
            self.automaton.add_word(seed, (len(seed), uses))
        if wanted:
            self.automaton.make_automaton()
        self.empty = not wanted
        #: No occurrence reaches further than this from a seed of it.
        self.reach = max([len(n) + 2 * k + 2 for n, k in self.edits.items()] + [len(p) + 2 for p in phrases] + [2])

    def _block(self, held: str, low: int, high: int) -> tuple[list[tuple[str, int]], set[Place]]:
        """Phrases and notices whose seeds start in held[low:high], by characters of `held`."""
        exact: list[tuple[str, int]] = []
        near: set[Place] = set()
        if self.empty:
            return exact, near
        for last, (length, uses) in self.automaton.iter(held):
            at = last - length + 1
            if not low <= at < high:
                continue
            for notice, phrase, offset in uses:
                if phrase is not None:
                    exact.append((phrase, at + 1))
                    continue
                k = self.edits[notice]
                left = max(0, at - offset - k - 1)
                match = self.patterns[notice].search(held[left:at - offset + len(notice) + k + 1])
                if match:
                    near.add(Place(notice, left + match.start(), left + match.end(), sum(match.fuzzy_counts)))
        return exact, near

    def scan(self, data: np.ndarray, piece: int = PIECE) -> tuple[int, list[tuple[str, int]], list[Place]]:
        """(words, phrases with their first words, notices) of a text's bytes."""
        held, done, before, chars = " ", 0, 0, 0
        phrases: list[tuple[str, int]] = []
        places: set[Place] = set()
        for words, last in _pieces(data, piece):
            if words:
                held += words + " "
            high = len(held) if last else len(held) - self.reach
            if high <= done and not last:
                continue
            exact, near = self._block(held, done, high)
            number = _numbers(held, [a for _, a in exact] + [p.at for p in near] + [p.to for p in near])
            phrases += [(p, before + number[a]) for p, a in exact]
            places |= {Place(p.notice, chars + p.at, chars + p.to, p.edits, before + number[p.at], before + number[p.to]) for p in near}
            if last:
                return before + held.count(" ") - 1, sorted(phrases, key=lambda x: (x[1], x[0])), best(places)
            cut = max(0, held.rfind(" ", 0, max(0, high - self.reach) + 1))
            before += held.count(" ", 0, cut)
            chars += cut
            held, done = held[cut:], high - cut
        raise AssertionError("a text has a last piece")


def _numbers(held: str, positions: list[int]) -> dict[int, int]:
    """For each position the number of words that start before it, less one if it starts a word itself."""
    out, at, n = {}, 0, 0
    for p in sorted(set(positions)):
        n += held.count(" ", at, p)
        at = p
        # `held` begins with a blank: the k-th blank stands before word k. An end stands on a blank.
        out[p] = n if held[p:p + 1] == " " else n - 1
    return out


def _pieces(data: np.ndarray, size: int) -> Iterator[tuple[str, bool]]:
    """The words of consecutive pieces, one blank between them, and whether the piece is the last."""
    at = 0
    while True:
        to = min(len(data), at + size)
        while to < len(data) and _WORD_BYTE[data[to]]:
            ends = np.flatnonzero(~_WORD_BYTE[data[to:to + 65536]])
            to = to + int(ends[0]) if len(ends) else min(len(data), to + 65536)
        words = data[at:to].tobytes().translate(_READ).split(b" ")
        yield b" ".join(filter(None, words)).decode(), to >= len(data)
        if to >= len(data):
            return
        at = to


def best(places: set[Place]) -> list[Place]:
    """Per notice without overlaps."""
    kept: dict[str, list[Place]] = {}
    for p in sorted(places, key=lambda p: (p.at, p.to, p.edits)):
        mine = kept.setdefault(p.notice, [])
        if mine and p.at < mine[-1].to:
            if p.edits < mine[-1].edits:
                mine[-1] = p
        else:
            mine.append(p)
    return sorted((p for ps in kept.values() for p in ps), key=lambda p: (p.at, p.to, p.notice))


@cache
def _finder() -> Finder:
    """One for each worker process."""
    return Finder(list(NOTICES), list(BASE))


_BASE_TYPE = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType())]))
_FOUND_TYPE = T.ArrayType(T.StructType([
    T.StructField("label", T.StringType()), T.StructField("notice", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("edits", T.IntegerType())]))
_RESULT = {"n_words": T.LongType(), "base": _BASE_TYPE, "notices": _FOUND_TYPE, "score": T.DoubleType()}


def score(n_base: int, places: Sequence[Place]) -> float:
    """1 for an unchanged notice, less for each edit relative to one more than it may hold, 0 without any."""
    return 1.0 if n_base else max((1 - p.edits / (allowed(p.notice) + 1) for p in places), default=0.0)


def _rows(texts: pa.Array) -> Iterator[np.ndarray]:
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    for a, b in zip(offsets, offsets[1:]):
        yield data[a:b]


def find_notices(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """The columns `keep` with `n_words`, `base` (label and first word of every place of a base phrase),
    `notices` (label, notice, words start to end, edits) and `score`."""
    keep = [c for c in keep if c not in _RESULT]
    named = [f"k{i}" for i in range(len(keep))]
    given = docs.select(*[quoted(c).alias(n) for c, n in zip(keep, named)], quoted(text).cast("string").alias("t"))
    schema = T.StructType([*given.schema.fields[:-1], *[T.StructField(n, t) for n, t in _RESULT.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder()
        base_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
        found_type = pa.list_(pa.struct([("label", pa.string()), ("notice", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())]))
        for batch in batches:
            n, base, found, scores = [], [], [], []
            for data in _rows(batch.column("t")):
                n_words, phrases, places = finder.scan(data)
                n.append(n_words)
                base.append([{"label": BASE[p], "start": w} for p, w in phrases])
                found.append([{"label": NOTICES[p.notice], "notice": p.notice, "start": p.start, "end": p.end, "edits": p.edits} for p in places])
                scores.append(score(len(phrases), places))
            made = [pa.array(n, pa.int64()), pa.array(base, base_type), pa.array(found, found_type), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in named], *made], names=schema.names)

    return given.mapInArrow(run, schema).select(*[F.col(n).alias(c) for n, c in zip(named, keep)], *_RESULT)


def labels(*columns: str) -> Column:
    """The distinct labels, sorted and comma-joined."""
    every = F.concat(*[F.transform(c, lambda x: x["label"]) for c in columns])
    return F.array_join(F.array_sort(F.array_distinct(every)), ",")
