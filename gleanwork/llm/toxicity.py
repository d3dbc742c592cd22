"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

A text's features are its distinct words (letters, digits and non-ASCII characters, A-Z folded) and their
beginnings of 3 to 8 bytes, and apart from these the beginnings that several of its words share, hashed to `SLOTS`. Voters are the words of a small lexicon and the
`LEARNT` features that tell toxic rows best among at most `SAMPLE` labelled rows (the smallest by
hash of id). Pattern voters look for `PHRASES` of several words and, for every longer lexicon word, for its disguises: digits for letters, signs for
letters, letters apart. A disguised word counts as the plain one too. A voter votes "toxic" or abstains.

The label model gives every voter a rate of votes on toxic and on other texts, by expectation
maximisation over the sample's votes. How often two voters vote together is counted over all
documents; what exceeds the rates' product is their correlation, and a voter's evidence is divided by one
plus its correlations, so that several voters for one word count about once. The posterior
labels so found, not the given ones, train a logistic regression on the `CHOSEN` features that differ most.

Null and empty texts have no feature and get the classifier's base score. Rows with a null label or id
are not learnt from; without toxic rows the lexicon alone votes. Empty table: empty result. Columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.llm.names import quoted
from gleanwork.llm.quality import added, held_out, training_rows
from gleanwork.llm.words import NOT_ALNUM, Words, byte_classes, chunks, constants, grams, mix, word_hashes, words_of
from gleanwork.session import staged

LEXICON = (
    "idiot idiots moron morons stupid dumb loser losers scum trash filth worthless pathetic disgusting clown bastard bitch "
    "asshole fuck fucking shit cunt whore slut retard imbecile jerk dumbass vermin degenerate hate kill "
    "idiota estúpido estúpida imbécil basura asqueroso puta mierda "
    "idiote crétin connard salope ordure dégoûtant "
    "dumm dummkopf arschloch abschaum hurensohn widerlich wertlos"
).split()
#: Abuse and threats over several words.
PHRASES = [
    "kill yourself", "kill you", "hurt you", "hate you", "shut up", "screw you", "go die", "drop dead", "go to hell", "burn in hell", "piece of shit",
    "piece of garbage", "son of a", "waste of space", "i hope you", "you will pay", "watch your back", "go back to",
    "cállate", "vete al", "te odio", "hijo de puta", "te voy a matar", "ferme la", "ta gueule", "va te faire", "je te déteste", "halt die", "halts maul", "ich hasse dich", "verpiss dich",
]
#: Digits written for letters, in two readings, and signs that stand for a letter.
READINGS = ({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}, {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t"})
SIGNS = b"*#@$!%"
#: Letters of a word that is looked for in disguise, at least.
LEAST_DISGUISED = 4
#: Score of a text with nothing but the vote of a voter that is silent in the sample.
ONE_VOTE = 0.6
BITS = 18
SLOTS = 1 << BITS
BEGINNINGS = (3, 4, 5, 6, 7, 8)
SAMPLE, LEARNT, CHOSEN = 20_000, 384, 4096
ROUNDS, STEPS, DECAY = 30, 300, 1e-3
THRESHOLD = 0.3


@dataclass
class Disguises:
    """What the pattern voters look for: hashes of the phrases by number of words, of plain words by length, and of (beginning, signs, ending)."""

    phrases: dict[int, np.ndarray]
    firsts: np.ndarray
    words: np.ndarray
    sizes: list[int]
    signed: np.ndarray
    signed_words: np.ndarray


def _hash_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return words_of(data, np.array([0, len(data)]), *byte_classes(NOT_ALNUM, fold=True)).hashes


def _of_signs(begin: np.ndarray, signs: int, end: np.ndarray) -> np.ndarray:
    a, b = constants(59, 2)
    with np.errstate(over="ignore"):
        return mix(begin * a + end * b + np.uint64(signs))


def disguised(word: np.ndarray) -> np.ndarray:
    """Hash of the voter for a word in any disguise."""
    return mix(word ^ constants(61, 1)[0])


@cache
def _disguises() -> Disguises:
    told = [_hash_of(p) for p in PHRASES]
    sizes = {len(h) for h in told}
    plain = [x for x in LEXICON if len(x) >= LEAST_DISGUISED]
    signed = {}
    for x in plain:
        for i in range(1, len(x) - 1):
            for j in range(i + 1, len(x)):
                signed[int(_of_signs(_hash_of(x[:i]), j - i, _hash_of(x[j:]))[0])] = int(_hash_of(x)[0])
    keys = np.array(sorted(signed), dtype=np.uint64)
    return Disguises(
        {n: np.sort(np.concatenate([grams(h, n) for h in told if len(h) == n])) for n in sizes}, np.unique([h[0] for h in told]),
        np.sort(np.concatenate([_hash_of(x) for x in plain])), sorted({len(x.encode()) for x in plain}),
        keys, np.array([signed[int(k)] for k in keys], dtype=np.uint64))


def _among(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def _patterns(data: np.ndarray, w: Words) -> list[np.ndarray]:
    """Numbered slots of the phrases, and of words spelt with digits, signs or blanks between; these count as the plain word too."""
    d, owner, found = _disguises(), w.owner(), []
    _, values = byte_classes(NOT_ALNUM, fold=True)

    def hidden(at: np.ndarray, word: np.ndarray) -> None:
        found.extend([_numbered(owner[at], word), _numbered(owner[at], disguised(word))])

    start = np.flatnonzero(_among(w.hashes, d.firsts))
    for n, told in d.phrases.items():
        at = start[start + n <= len(owner)]
        at = at[owner[at] == owner[at + n - 1]]
        said = grams(w.hashes[at[:, None] + np.arange(n)].ravel(), n)[::n]
        found.append(_numbered(owner[at[_among(said, told)]], said[_among(said, told)]))
    # Words with digits for letters.
    size = w.ends - w.starts
    with_digit = distinct(np.searchsorted(w.starts, np.flatnonzero((data >= 48) & (data <= 57)), "right") - 1)
    at = with_digit[size[with_digit] <= d.sizes[-1]]
    ends = np.cumsum(size[at])
    letters = data[np.arange(int(size[at].sum())) + np.repeat(w.starts[at] - ends + size[at], size[at])]
    for reading in READINGS:
        read = values.copy()
        read[[ord(x) for x in reading]] = values[[ord(x) for x in reading.values()]]
        word = word_hashes(letters, ends - size[at], ends, read)
        hidden(at[_among(word, d.words)], word[_among(word, d.words)])
    # Signs for letters: two words with nothing but signs between.
    is_sign = np.zeros(256, dtype=bool)
    is_sign[list(SIGNS)] = True
    near = np.flatnonzero(is_sign[data[w.ends[:-1]]] & (owner[1:] == owner[:-1]))
    gap = w.starts[near + 1] - w.ends[near]
    for n in range(1, d.sizes[-1] - 1):
        at = near[gap == n]
        at = at[is_sign[data[w.ends[at][:, None] + np.arange(n)]].all(axis=1)]
        key = _of_signs(w.hashes[at], n, w.hashes[at + 1])
        hidden(at[_among(key, d.signed)], d.signed_words[np.searchsorted(d.signed, key[_among(key, d.signed)])])
    # Letters with one byte between.
    single = np.flatnonzero(size == 1)
    if len(single):
        apart = (np.diff(single) > 1) | (w.starts[single[1:]] != w.ends[single[:-1]] + 1) | (owner[single[1:]] != owner[single[:-1]])
        run = np.concatenate([[0], np.cumsum(apart)])
        letters = data[w.starts[single]]
        for n in d.sizes:
            at = np.flatnonzero(run[n - 1:] == run[:max(0, len(run) - n + 1)])
            word = word_hashes(letters, at, at + n, values)
            hidden(single[at[_among(word, d.words)]], word[_among(word, d.words)])
    return found


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slot, text) of the distinct features and patterns, by text."""
    w = words_of(data, offsets, *byte_classes(NOT_ALNUM, fold=True))
    patterns = _patterns(data, w)
    folded = np.arange(256, dtype=np.uint64)
    folded[65:91] += 32
    # Each text's distinct words.
    owner = w.owner()
    order = np.lexsort((w.hashes, owner))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (w.hashes[order[1:]] != w.hashes[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    kept = order[new]
    hashes, owner, starts, size = w.hashes[kept], owner[kept], w.starts[kept], (w.ends - w.starts)[kept]
    found, seeds = [_numbered(owner, hashes)], constants(53, max(BEGINNINGS) + 1)
    with np.errstate(over="ignore"):
        for n in BEGINNINGS:
            long = np.flatnonzero(size > n)
            x = np.zeros(len(long), dtype=np.uint64)
            for i in range(n):
                x |= folded[data[starts[long] + i]] << np.uint64(8 * i)
            once, times = np.unique(_numbered(owner[long], mix(x * seeds[n] + np.uint64(n))), return_counts=True)
            several = once[times > 1]
            found += [once, _numbered(several >> BITS, mix(several.astype(np.uint64) & np.uint64(SLOTS - 1) ^ seeds[n]))]
    both = distinct(np.concatenate([*found, *patterns]))
    return both & (SLOTS - 1), both >> BITS


def distinct(x: np.ndarray) -> np.ndarray:
    """The different values, ascending. Sorted, as `np.unique` may put them through a hash table first, which costs far more."""
    x = np.sort(x)
    new = np.ones(len(x), dtype=bool)
    new[1:] = x[1:] != x[:-1]
    return x[new]


def _numbered(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return (owner.astype(np.int64) << BITS) | (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def slots_of_words(words: Sequence[str]) -> np.ndarray:
    out = []
    for word in words:
        data = np.frombuffer(word.encode(), np.uint8)
        h = words_of(data, np.array([0, len(data)]), *byte_classes(NOT_ALNUM, fold=True)).hashes
        out.append(int(h[0] >> np.uint64(64 - BITS)))
    return np.array(out)


def slots_of_patterns() -> np.ndarray:
    """Of the voters for phrases and for disguised words."""
    d = _disguises()
    return np.concatenate([(x >> np.uint64(64 - BITS)).astype(np.int64) for x in (*d.phrases.values(), disguised(d.words))])


def _per_batch(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for row, to, data, offsets in chunks(batch.column(name)):
        yield row, to, *features(data, offsets)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slot the toxic and the other rows that have it; at slot -1 all rows."""
    counts, rows = np.zeros((2, SLOTS), dtype=np.int64), np.zeros(2, dtype=np.int64)
    for batch in batches:
        y = batch.column("y").to_numpy()
        rows += np.bincount(y, minlength=2)[:2]
        for row, to, slot, owner in _per_batch(batch, "text"):
            for value in (0, 1):
                counts[value] += np.bincount(slot[y[row:to][owner] == value], minlength=SLOTS)
    at = np.flatnonzero(counts.sum(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1)), pa.array(np.append(counts[1, at], rows[1])), pa.array(np.append(counts[0, at], rows[0]))], names=["slot", "ones", "zeros"])


def _reduced(voters: np.ndarray, chosen: np.ndarray) -> Callable:
    """Each labelled row's votes and chosen features, by number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vote_of, feature_of = (np.full(SLOTS, -1) for _ in range(2))
        vote_of[voters], feature_of[chosen] = np.arange(len(voters)), np.arange(len(chosen))
        for batch in batches:
            for row, to, slot, owner in _per_batch(batch, "text"):
                lists = []
                for number in (vote_of, feature_of):
                    x = number[slot]
                    use = x >= 0
                    ends = np.searchsorted(owner[use], np.arange(to - row + 1))
                    lists.append(pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(x[use].astype(np.int32))))
                yield pa.RecordBatch.from_arrays(lists, names=["votes", "features"])
    return run


def _together(voters: np.ndarray) -> Callable:
    """How many texts each two voters vote on; the last row counts all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vote_of = np.full(SLOTS, -1)
        vote_of[voters] = np.arange(len(voters))
        total, texts = np.zeros((len(voters), len(voters))), 0
        for batch in batches:
            texts += len(batch)
            for row, to, slot, owner in _per_batch(batch, "text"):
                x = vote_of[slot]
                use = x >= 0
                who, at = np.unique(owner[use], return_inverse=True)
                votes = np.zeros((len(who), len(voters)), dtype=np.float32)
                votes[at, x[use]] = 1
                total += votes.T @ votes
        rows = [r.astype(np.int64).tobytes() for r in total] + [np.int64(texts).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.binary())], names=["block", "sums"])
    return run


def _chosen(counts: list, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(learnt voters, features of the classifier) by how surely their shares differ."""
    slot = np.array([r["slot"] for r in counts], dtype=np.int64)
    ones, zeros = (np.array([r[c] for r in counts], dtype=np.float64) for c in ("ones", "zeros"))
    p1, p0 = (ones + 0.5) / (n[1] + 1), (zeros + 0.5) / (n[0] + 1)
    sure = (p1 - p0) / np.sqrt(p1 * (1 - p1) / (n[1] + 1) + p0 * (1 - p0) / (n[0] + 1))
    # A voter is mostly right when it votes.
    right = (ones >= 3) & (ones * (n[0] + 1) >= 10 * (zeros + 0.5) * (n[1] + 1)) & (ones >= zeros)
    order = np.lexsort((slot, -sure))
    voters = slot[order[right[order]][:LEARNT]]
    return voters, slot[np.lexsort((slot, -np.abs(sure)))[:CHOSEN]]


def label_model(votes: np.ndarray, together: np.ndarray, texts: int, share: float) -> np.ndarray:
    """Probability of "toxic" per row of a 0/1 vote matrix."""
    fired = votes.sum(axis=1)
    q = 1 - 0.4 ** fired
    for _ in range(ROUNDS):
        a = ((q @ votes) + 0.1) / (q.sum() + 1)
        b = (((1 - q) @ votes) + 0.01) / ((1 - q).sum() + 1)
        pi = np.clip(q.mean(), 1e-4, 0.9)
        z = np.log(pi / (1 - pi)) + votes @ np.log(a / b) + (1 - votes) @ np.log((1 - a) / (1 - b))
        q = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    expected = pi * np.outer(a, a) + (1 - pi) * np.outer(b, b)
    rate = np.diag(together) / max(1, texts)
    spread = np.sqrt(np.outer(rate * (1 - rate), rate * (1 - rate))) + 1e-12
    excess = np.clip((together / max(1, texts) - expected) / spread, 0, 1)
    np.fill_diagonal(excess, 0)
    evidence = votes @ (np.log(a / b) / (1 + excess.sum(axis=1)))
    # The level at which the mean posterior is the share of toxic rows.
    low, high = -40.0, 40.0
    for _ in range(60):
        mid = (low + high) / 2
        if np.mean(1 / (1 + np.exp(-np.clip(mid + evidence, -40, 40)))) > share:
            high = mid
        else:
            low = mid
    return 1 / (1 + np.exp(-np.clip(low + evidence, -40, 40)))


def train(row: np.ndarray, at: np.ndarray, y: np.ndarray, size: int) -> np.ndarray:
    """Weights of a logistic regression, the intercept last; row `row[i]` has the feature `at[i]`."""
    w, first, second = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, STEPS + 1 if len(y) else 1):
        z = np.bincount(row, weights=w[at], minlength=len(y)) + w[-1]
        g = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y) / len(y)
        grad = np.append(np.bincount(at, weights=g[row], minlength=size), g.sum())
        grad[:-1] += DECAY * w[:-1] / 10
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad ** 2
        w = w - 0.05 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-9)
    return w


def _entries(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(row, number) of all numbers in a column of lists."""
    lists = lists.combine_chunks()
    return np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()


def _scored(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, w = shared.value
        weight = np.zeros(SLOTS)
        weight[chosen] = w[:-1]
        for batch in batches:
            score = np.zeros(len(batch))
            for row, to, slot, owner in _per_batch(batch, "__text"):
                score[row:to] = np.bincount(owner, weights=weight[slot], minlength=to - row)
            score = 1 / (1 + np.exp(-np.clip(score + w[-1], -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], names=[*batch.schema.names[:-1], "score"])
    return run


def score_toxicity(
    docs: DataFrame, labels: DataFrame, keep: Sequence[str], key: str = "doc_id", text: str = "text", label: str = "toxic",
    folds: int = 4, fold: int = 2, sample: int = SAMPLE,
) -> DataFrame:
    """The columns `keep` of every document with `held_out`, `score` and `predicted`."""
    context = docs.sparkSession.sparkContext
    # At most `sample` rows on either side.
    wanted = F.broadcast(training_rows(labels, key, label, folds, fold, sample))
    known = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(wanted, F.col("k") == F.col("__labelled"))
    # Repeated rows count once; ids that many texts share are cut by hash of the text.
    known = known.select("k", "text", "y").distinct().orderBy(F.xxhash64("k"), "k", F.xxhash64("text"), "y").limit(sample)
    known = staged(known.select("text", "y"), "labelled")
    counts = known.mapInArrow(_counted, "slot long, ones long, zeros long").groupBy("slot").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    counts = counts.collect()  # at most SLOTS + 1 rows
    n = np.array([[r["zeros"], r["ones"]] for r in counts if r["slot"] == -1], dtype=np.float64).reshape(-1, 2).sum(axis=0)
    learnt, chosen = _chosen([r for r in counts if r["slot"] >= 0], n)
    told = np.unique(np.concatenate([slots_of_words(LEXICON), slots_of_patterns()]))
    voters = np.unique(np.concatenate([told, learnt]).astype(np.int64))
    chosen = np.unique(np.concatenate([chosen, voters]))
    pairs = docs.select(F.col(text).alias("text")).mapInArrow(_together(voters), "block long, sums binary")
    pairs = {r["block"]: np.frombuffer(r["sums"], np.int64) for r in pairs.groupBy("block").applyInArrow(added, "block long, sums binary").collect()}
    together = np.array([pairs.get(i, np.zeros(len(voters))) for i in range(len(voters))])
    texts = int(pairs.get(len(voters), [0])[0])
    rows = known.mapInArrow(_reduced(voters, chosen), "votes array<int>, features array<int>").toArrow()
    votes = np.zeros((len(rows), len(voters)), dtype=np.float32)
    votes[_entries(rows["votes"])] = 1
    share = (n[1] + 0.5) / (n.sum() + 1)
    y = label_model(votes, together, texts, share) if len(rows) else np.zeros(0)
    weights = train(*_entries(rows["features"]), y, len(chosen))
    # A voter of the lists that is silent in the sample has the weight by which a text with its vote alone gets `ONE_VOTE`.
    silent = np.searchsorted(chosen, told[votes[:, np.searchsorted(voters, told)].sum(axis=0) == 0])
    weights[silent] = max(0.0, np.log(ONE_VOTE / (1 - ONE_VOTE)) - weights[-1]) if len(y) else 0.0
    shared = context.broadcast((chosen, weights))
    own = {c: f"own_{i}" for i, c in enumerate(keep) if c not in ("held_out", "score", "predicted")}
    out = docs.select(*[quoted(c).alias(v) for c, v in own.items()], F.col(key).alias("__key"), F.col(text).alias("__text"))
    out = out.mapInArrow(_scored(shared), T.StructType([*out.schema.fields[:-1], T.StructField("score", T.DoubleType())]))
    return out.select(
        *[F.col(v).alias(c) for c, v in own.items()], held_out(F.col("__key"), folds, fold).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
