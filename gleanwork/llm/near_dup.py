"""Near-duplicates: an inverted join on the coordinates of MinHash signatures, confirmed on full sets.

Words are `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased; a document's set is its distinct shingles
(64-bit hashes) of `shingle` words, five unless stated. Documents with equal sets form a class, and only classes are compared.

1. Every class is posted under its 64 (coordinate, value) pairs. Only values that two classes share can
   collide. Two classes with similarity 0.8 collide in 51 coordinates on average and in fewer than
   `LEAST` of them with probability 2e-6; pairs below `LEAST` are no candidates.
2. Star: each list names two leaders, its smallest and largest class. (class, leader) collisions are
   counted; pairs with `LEAST` or more are checked. That joins most of a large group with at most
   two checks per class.
3. Prefix: of a class's shared values, rarest first, only so many are kept that two classes with
   `LEAST` collisions must meet in one (long lists of common values are thus skipped). Lists whose
   classes are connected already are dropped. In the others each class outside the list's largest
   component meets the classes of other components, in tiles of bounded size; a pair is merged from its
   signatures only in the first list both prefixes share. Pairs at `LEAST` collisions or more are
   checked, within the tile, on their full sets; no list of pairs is written but of the links that connect.

Components run over the links of both steps. Texts are shuffled where an exact join needs them only: before it a sieve, a
bitmap of hashed (id, text) keys that is broadcast, holds back the rows that are surely not in the join's other table. So
the texts of classes with enough shared values and, in `keep_one`, of the documents that go travel, and a few others.

Null or wordless texts have an empty set and are linked with nothing. A document without id takes part
and is never the smallest unless its whole component has none. In `near_duplicates` rows with equal ids are alike kept or not;
`keep_one` keeps one row of each component. Empty table: empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanwork.llm.components import components
from gleanwork.llm.words import BLANKS, Words, byte_classes, chunks, constants, grams, mix, words_of
from gleanwork.session import released, staged

SHINGLE = 5
PERCENT = 80
COORDINATES = 64
#: Collisions that make a candidate.
LEAST = 36
TILE = 2048
#: Rows of one grouped task, about.
BIN_ROWS = 4096
#: Bits of a sieve for each key, and in all at most (32 MB); beyond, a sieve lets more rows pass, and the join decides.
SIEVE, SIEVE_MOST = 16, 1 << 28
#: Bits of one of Spark's bitmaps.
BITMAP = 1 << 15


def shingle_sets(w: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the distinct shingles of each text, sorted; text i has first[i]:first[i+1]."""
    n = np.diff(w.first)
    inside = np.repeat(w.first[1:], n) - np.arange(len(w.hashes))
    owner = np.repeat(np.arange(len(n)), n)
    at = np.flatnonzero(inside >= shingle)
    hashes, owners = [grams(w.hashes, shingle)[at]], [owner[at]]
    for length in range(1, shingle):
        short = np.flatnonzero(n == length)
        rows = w.first[short][:, None] + np.arange(length)
        with np.errstate(over="ignore"):
            hashes.append(mix((w.hashes[rows] * constants(100 + length, length)).sum(axis=1, dtype=np.uint64)) if len(short) else np.zeros(0, np.uint64))
        owners.append(short)
    h, o = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((h, o))
    h, o = h[order], o[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    h, o = h[new], o[new]
    return h, np.searchsorted(o, np.arange(len(n) + 1))


def _per_text(fold: Callable, x: np.ndarray, first: np.ndarray, full: np.ndarray) -> np.ndarray:
    return fold.reduceat(x, first[:-1][full]) if full.any() else np.zeros(0, x.dtype)


def _identities(h: np.ndarray, first: np.ndarray, full: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name a set."""
    with np.errstate(over="ignore"):
        return (_per_text(np.add, mix(h * np.uint64(0x9E3779B97F4A7C15 | 1)), first, full).view(np.int64),
                _per_text(np.add, mix(h ^ np.uint64(0xC2B2AE3D27D4EB4F)), first, full).view(np.int64))


def _signed(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, values = byte_classes(BLANKS, fold=True)
        a, b = constants(31, COORDINATES), constants(37, COORDINATES)
        for batch in batches:
            for row, to, data, offsets in chunks(batch.column("text")):
                h, first = shingle_sets(words_of(data, offsets, inside, values), shingle)
                full = np.diff(first) > 0
                size, f1, f2 = np.diff(first), np.zeros(to - row, np.int64), np.zeros(to - row, np.int64)
                f1[full], f2[full] = _identities(h, first, full)
                sig = np.zeros((to - row, COORDINATES), dtype=np.int32)
                with np.errstate(over="ignore"):
                    for k in range(COORDINATES):
                        low = _per_text(np.minimum, ((h * a[k] + b[k]) >> np.uint64(32)).astype(np.uint32), first, full)
                        sig[full, k] = low.view(np.int32)
                lists = pa.ListArray.from_arrays(np.arange(to - row + 1, dtype=np.int32) * COORDINATES, pa.array(sig.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc")[row:to], batch.column("tk")[row:to], pa.array(size.astype(np.int64)), pa.array(f1), pa.array(f2), lists],
                    names=["doc", "tk", "n", "f1", "f2", "sig"])

    return run


def _sets(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, values = byte_classes(BLANKS, fold=True)
        for batch in batches:
            for row, to, data, offsets in chunks(batch.column("text")):
                h, first = shingle_sets(words_of(data, offsets, inside, values), shingle)
                rows = [h[x:y].tobytes() for x, y in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("cls")[row:to], pa.array(rows, pa.binary())], names=["cls", "members"])

    return run


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def _confirmed(key: tuple, pairs: pa.Table, sets: pa.Table) -> pa.Table:
    """The links among a bin's pairs; of pairs that would close a ring only the first ones."""
    members = {c: np.frombuffer(m, np.uint64) for c, m in zip(sets["cls"].to_pylist(), sets["members"].to_pylist(), strict=True)}
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for row in pairs.to_pylist():
        for a, b in zip(row["ys"], row["xs"], strict=True):
            if find(a) != find(b) and _similar(members[a], members[b]):
                root[find(a)] = find(b)
                out.append((a, b))
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def _confirm(pairs: DataFrame, sets: DataFrame, rows: int) -> DataFrame:
    """pairs: (blk, ys, xs, members), aligned lists; the sets travel once per block."""
    bins = max(1, rows // BIN_ROWS)
    bin_of = F.pmod(F.xxhash64("blk"), F.lit(bins)).alias("bin")
    needed = pairs.select(bin_of, F.explode("members").alias("cls")).distinct()
    return pairs.select(bin_of, "ys", "xs").groupBy("bin").cogroup(
        needed.join(sets, "cls").select("bin", "cls", "members").groupBy("bin")
    ).applyInArrow(_confirmed, "a long, b long")


def _candidates(key: tuple, rows: pa.Table) -> pa.Table:
    """Pairs of a bin's tiles that collide often enough, each in one tile only."""
    tile = rows["blk"].to_numpy()
    order = np.argsort(tile, kind="stable")
    rows = rows.take(pa.array(order)).combine_chunks()
    tile = tile[order]
    cls, comp, mask = (rows[c].to_numpy() for c in ("cls", "comp", "mask"))
    coordinate, probe, rest = (rows[c].to_numpy() for c in ("coordinate", "probe", "outside"))
    sig = rows["sig"].combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
    bits = np.int64(1) << np.arange(COORDINATES, dtype=np.int64)
    cuts = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
    out: dict[str, list] = {"blk": [], "ys": [], "xs": [], "members": []}
    for lo, hi in zip(cuts, [*cuts[1:], len(tile)], strict=True):
        p = lo + np.flatnonzero(probe[lo:hi])
        m = lo + np.flatnonzero(~probe[lo:hi])
        step = max(1, 65536 // max(1, len(m)))
        ys, xs = [], []
        for k in range(0, len(p), step):
            y, x = (v.ravel() for v in np.meshgrid(p[k:k + step], m, indexing="ij"))
            use = (comp[y] != comp[x]) & (~rest[x] | (cls[y] < cls[x]))
            y, x = y[use], x[use]
            same = sig[y] == sig[x]
            use = same.sum(axis=1) >= LEAST
            y, x, same = y[use], x[use], same[use]
            common = same & (((mask[y] & mask[x])[:, None] & bits) != 0)
            use = common.argmax(axis=1) == coordinate[y]
            ys.append(cls[y[use]])
            xs.append(cls[x[use]])
        if ys and sum(map(len, ys)):
            ys, xs = np.concatenate(ys), np.concatenate(xs)
            for name, v in (("blk", int(tile[lo])), ("ys", ys), ("xs", xs), ("members", np.unique(np.concatenate([ys, xs])))):
                out[name].append(v)
    longs = pa.list_(pa.int64())
    return pa.table({"blk": pa.array(out["blk"], pa.int64()), **{c: pa.array(out[c], longs) for c in ("ys", "xs", "members")}})


def _best() -> Column:
    """Orders documents by id, those without one last, then by text."""
    return F.struct(F.col("doc").isNull().alias("none"), F.col("doc"), F.col("tk"))


def _classes(signed: DataFrame) -> DataFrame:
    """One row per distinct set, numbered as written."""
    per = signed.filter(F.col("n") > 0).groupBy("f1", "f2", "n").agg(
        F.min("doc").alias("low_doc"), F.min(_best()).alias("one"), F.first("sig").alias("sig"))
    return staged(per.select(F.monotonically_increasing_id().alias("cls"), "f1", "f2", "n", "low_doc", "one.doc", "one.tk", "sig"), "classes")


def _postings(classes: DataFrame) -> DataFrame:
    """(cls, token, n, l0, l1) of the values that two classes share, for classes that share `LEAST` or more."""
    tokens = classes.select("cls", F.posexplode("sig")).select(
        "cls", F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("col").cast("long").bitwiseAND(F.lit((1 << 32) - 1))).alias("token"))
    lists = tokens.groupBy("token").agg(F.count("*").alias("n"), F.min("cls").alias("l0"), F.max("cls").alias("l1")).filter("n > 1")
    # From a written table Spark can split a value that many classes share.
    lists = staged(lists, "lists")
    released(classes.sparkSession)
    shared = tokens.join(lists, "token")
    enough = shared.groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("n", "token", "l0", "l1"))).alias("lists"))
    return staged(enough.filter(F.size("lists") >= LEAST), "postings")


def _stars(postings: DataFrame) -> DataFrame:
    leaders = postings.select("cls", F.explode(F.flatten(F.transform("lists", lambda x: F.array_distinct(F.array(x["l0"], x["l1"]))))).alias("leader"))
    pairs = leaders.filter("cls != leader").groupBy("cls", "leader").count().filter(F.col("count") >= LEAST)
    pairs = staged(pairs.select("cls", "leader"), "stars")
    followers = pairs.groupBy("leader").agg(F.ceil(F.count("*") / F.lit(TILE)).alias("parts"))
    blocks = pairs.join(followers, "leader").groupBy("leader", F.pmod(F.xxhash64("cls"), "parts").alias("part")).agg(F.collect_list("cls").alias("xs"))
    return blocks.select(
        F.xxhash64("leader", "part").alias("blk"), F.transform("xs", lambda x: F.col("leader")).alias("ys"), "xs",
        F.concat("xs", F.array("leader")).alias("members"))


def _tiles(postings: DataFrame, low: DataFrame, classes: DataFrame) -> DataFrame:
    """The prefix lists that still hold several components, cut into tiles."""
    prefix = postings.join(low.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", F.coalesce("low", "cls").alias("comp"),
        F.transform(F.slice("lists", F.lit(1), F.size("lists") - (LEAST - 1)), lambda x: x["token"]).alias("tokens"))
    bit = lambda m, t: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(t, 32).cast("int")))
    prefix = staged(prefix.select("cls", "comp", F.aggregate("tokens", F.lit(0).cast("long"), bit).alias("mask"), F.explode("tokens").alias("token")), "prefix")
    lists = prefix.groupBy("token", "comp").agg(F.count("*").alias("n")).groupBy("token").agg(
        F.max_by("comp", F.struct("n", "comp")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"), F.count("*").alias("comps"))
    lists = lists.filter("comps > 1").select(
        "token", "main", F.ceil(F.col("all") / F.lit(TILE)).cast("int").alias("rows"),
        F.ceil((F.col("all") - F.col("most")) / F.lit(TILE)).cast("int").alias("probes"))
    met = prefix.join(staged(lists, "lists"), "token").withColumn("outside", F.col("comp") != F.col("main"))
    part = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["token", "cls", "comp", "mask", "outside"]
    members = met.select(*columns, F.lit(False).alias("probe"), part("rows").alias("i"), every("probes").alias("j"))
    probes = met.filter("outside").select(*columns, F.lit(True).alias("probe"), part("probes").alias("j"), every("rows").alias("i"))
    tiles = members.unionByName(probes).select(
        F.xxhash64("token", "i", "j").alias("blk"), "cls", "comp", "mask", "outside", "probe",
        F.shiftright("token", 32).cast("int").alias("coordinate"))
    return tiles.join(classes.select("cls", "sig"), "cls")


def _sieved(rows: DataFrame, key: Column, tk: Column, wanted: DataFrame) -> DataFrame:
    """The rows with `__met`: false only where (key, tk) is no (__doc, __tk) of the written table `wanted`. No row is shuffled for it."""
    bits = max(BITMAP, min(SIEVE_MOST, SIEVE * wanted.count()))
    place = lambda k, t: F.pmod(F.xxhash64(k, t), F.lit(bits)) + 1
    at = place(F.col("__doc"), F.col("__tk"))
    maps = wanted.groupBy(F.bitmap_bucket_number(at).alias("__map")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("__bits"))
    at = place(key, tk)
    bit = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("__bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    met = F.call_function("getbit", byte, F.pmod(bit, F.lit(8)).cast("int")) == 1
    return rows.join(F.broadcast(maps), F.bitmap_bucket_number(at) == F.col("__map"), "left").select(*rows.columns, F.coalesce(met, F.lit(False)).alias("__met"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document."""
    found = _labelled(docs, key, text, shingle)
    return found.select(F.col("doc").alias(key), "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of each component, with all its columns unchanged: the one with the smallest id, rows
    without id last; then by hash of the text, then of all columns. Rows without words all stay."""
    own = {c: f"own_{i}" for i, c in enumerate(docs.columns)}
    docs, key, text = docs.toDF(*own.values()), own[key], own[text]
    found = _labelled(docs, key, text, shingle).filter("n_shingles > 0")
    seen = found.groupBy(F.col("doc").alias("__doc"), F.col("tk").alias("__tk")).agg(F.first("best").alias("__best"), F.count("*").alias("n"))
    # Texts that go, and those of which one of several rows stays.
    marked = staged(seen.filter("n > 1 OR NOT __best").drop("n"), "duplicates")
    del found, seen
    released(docs.sparkSession)
    tk = F.xxhash64(F.col(text))
    same = F.col(key).eqNullSafe(F.col("__doc")) & (tk == F.col("__tk"))
    tested = _sieved(docs, F.col(key), tk, marked)
    kept = tested.filter("NOT __met").drop("__met").unionByName(tested.filter("__met").drop("__met").join(marked, same, "left_anti"))
    several = marked.filter("__best")
    if several.isEmpty():
        return kept.toDF(*own)
    repeated = _sieved(docs, F.col(key), tk, several).filter("__met").drop("__met").join(several, same)
    order = Window.partitionBy("__doc", "__tk").orderBy(F.xxhash64(F.to_json(F.struct(*docs.columns))))
    first = repeated.withColumn("__row", F.row_number().over(order)).filter("__row = 1").select(*docs.columns)
    return kept.unionByName(first).toDF(*own)


def _labelled(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    spark = docs.sparkSession
    released(spark)
    slim = docs.select(F.col(key).alias("doc"), F.xxhash64(F.col(text)).alias("tk"), F.col(text).alias("text"))
    kind = slim.schema["doc"].dataType.simpleString()
    signed = staged(slim.mapInArrow(_signed(shingle), f"doc {kind}, tk long, n long, f1 long, f2 long, sig array<int>"), "signatures")
    classes = _classes(signed)
    released(spark)
    postings = _postings(classes)
    released(spark)
    wanted = classes.join(postings.select("cls"), "cls", "left_semi").select("cls", F.col("doc").alias("__doc"), F.col("tk").alias("__tk"))
    wanted = staged(wanted, "wanted")
    met = _sieved(slim, F.col("doc"), F.col("tk"), wanted).filter("__met").drop("__met")
    found = met.join(wanted, F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("tk") == F.col("__tk")))
    sets = staged(found.select("cls", "text").mapInArrow(_sets(shingle), "cls long, members binary"), "sets")
    del wanted, met, found
    released(spark)
    links = staged(_confirm(_stars(postings), sets, postings.count()), "links")
    released(spark)
    low = components(links)
    released(spark)
    tiles = staged(_tiles(postings, low, classes), "tiles")
    released(spark)
    n = tiles.count()
    bins = F.pmod(F.xxhash64("blk"), F.lit(max(1, n // BIN_ROWS)))
    met = staged(tiles.groupBy(bins.alias("bin")).applyInArrow(_candidates, "blk long, ys array<long>, xs array<long>, members array<long>"), "pairs")
    released(spark)
    involved = met.agg(F.sum(F.size("members")).alias("n")).first()["n"] or 0
    # Written first: the few tasks that read it contract more than the many that confirm.
    low = components(links.union(staged(_confirm(met, sets, involved), "links")))
    released(spark)
    named = classes.join(low.withColumnRenamed("node", "cls"), "cls", "left").select("f1", "f2", "n", "low_doc", "doc", "tk", F.coalesce("low", "cls").alias("comp"))
    least = named.groupBy("comp").agg(F.min("low_doc").alias("component"), F.min(_best()).alias("one"))
    named = staged(named.join(least, "comp").select("f1", "f2", F.col("n").alias("size"), "component", F.col("one.doc").alias("one_doc"), F.col("one.tk").alias("one_tk")), "components")
    del least
    released(spark)
    out = signed.select("doc", "tk", "n", "f1", "f2").join(
        named.withColumnsRenamed({"f1": "g1", "f2": "g2"}), (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2")) & (F.col("n") == F.col("size")), "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc"))
    best = F.col("doc").eqNullSafe(F.col("one_doc")) & (F.col("tk") == F.col("one_tk"))
    return out.select("doc", "tk", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc").eqNullSafe(component).alias("kept"), best.alias("best"))
