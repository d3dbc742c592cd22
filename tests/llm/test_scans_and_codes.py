"""Conversations, codes and licence notices against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gleanwork.llm import codes, conversations, licenses, queries
from tests.llm import brute
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


@pytest.mark.parametrize("name", ["op11_conversations", "op12_codes"])
def test_against_sql(spark, name):
    verdict, _ = compare(spark, connect(SF), name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert verdict.startswith("ok") and "types" not in verdict, verdict


# --- conversations ------------------------------------------------------------------------------------------


def odd_conversations():
    rng = random.Random(3)
    texts = ["a.", "b!", "", "  ", "trunc", "ok?", "x", "y. ", None, "é.", "\x85"]
    roles = ["user", "assistant", "system", "tool", None, "", "user", "assistant"]
    rows = []
    for conv in range(40):
        n = rng.choice([0, 1, 2, 3, 5, 8, 20])
        rows += [(conv if conv % 17 else None, rng.choice([t, t, t, t // 2, None]), rng.choice(roles),
                  rng.choice(texts) if rng.random() < 0.4 else f"t{rng.randrange(10**6)}{rng.choice(['.', '', '!'])}") for t in range(n)]
    rows += [rows[5]] * 7
    # Runs whose costs never lose rank, and runs that are all kept or all deleted.
    rows += [(1000, t, "tool", f"x{t}") for t in range(60)] + [(1001, t, ["user", "assistant"][t % 2], f"x{t}.") for t in range(60)]
    rows += [(1002, t, "user", "") for t in range(60)] + [(1003, 0, "user", "long. " * 50000), (1003, 2**62, "assistant", "ok.")]
    return rows


@pytest.mark.parametrize("size", [256, 4])
def test_conversations(spark, size):
    given = odd_conversations()
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, text string").withColumns({"conv": F.lit("x"), "a.b": F.lit(1), "digest": F.lit(2)}).repartition(5)
    rows = conversations.rows_of(conversations.damaged(df), "conv", copies="copies")
    got = {r[0]: tuple(r)[1:] for r in conversations.report(df.select(F.col("conv_id").alias("conv")), rows, size).collect()}
    assert got == brute.conversations(given, brute.damage(given))


def test_repaired_conversations_are_well_formed(spark):
    given = odd_conversations()
    rows = conversations.rows_of(spark.createDataFrame(given, "conv_id long, turn long, role string, text string").repartition(3))
    script, found = conversations.repair(rows, 8)
    turns = {}
    for r in conversations.repaired(rows, script).orderBy("conv", "place").collect():
        turns.setdefault(r["conv"], []).append(r)
    report = {r["conv"]: r for r in found.collect()}
    for conv, mine in turns.items():
        initials = "".join(r["role"][0] for r in mine)
        rest = initials.removeprefix("s")
        assert rest == "ua" * (len(rest) // 2) and [r["place"] for r in mine] == list(range(len(mine)))
        of = sorted((r[1:] for r in given if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, brute.hashlib.sha256(f"{len(r[1] or ' ' * (r[1] is None))}:{' ' if r[1] is None else r[1]}:{' ' if r[2] is None else r[2]}".encode()).digest()))
        want = brute.repair([(t, " " if r is None else r, " " if x is None else x) for t, r, x in of])
        assert [f"{r['role']}:{r['text']}" for r in mine] == want[-1] and report[conv]["cost"] == want[5]


def test_conversations_of_an_empty_table_and_of_dropped_rows(spark):
    schema = "conv_id string, turn int, role string, text string"
    for given in ([], [("c", t, "user", "x") for t in range(200) if brute.damage([("c", t, "user", "x")]) == []]):
        df = spark.createDataFrame(given, schema)
        rows = conversations.rows_of(conversations.damaged(df), "conv", copies="copies")
        got = [tuple(r) for r in conversations.report(df.select(F.col("conv_id").alias("conv")), rows).collect()]
        assert got == ([("c", 0, 0, 0, 0, 0, 0, "", brute.sha(""))] if given else [])


def test_fix_ups_stop_where_vectors_differ_by_a_constant():
    rng = random.Random(1)
    for _ in range(200):
        row = bytes(rng.randrange(12) for _ in range(30))
        values = []
        for given in ("0,6,3,0,", "5,0,2,9,u"):
            values.append((given, *conversations._backward(row, given, None)))
        for a in values:
            for b in values:
                assert conversations._backward(row, b[0], a) == b[1:]


# --- codes --------------------------------------------------------------------------------------------------


def test_slices_find_the_nearest_entry():
    rng = np.random.default_rng(0)
    for n, dims, spread in ((64, 4, 30), (64, 4, 2), (5, 1, 10), (64, 3, 10**9), (1, 2, 5)):
        entries, x = rng.integers(-spread, spread + 1, (n, dims)), rng.integers(-spread, spread + 1, (500, dims))
        kinds = [np.int64, object] if spread < 10**6 else [object]
        for kind in kinds:
            e, v = entries.astype(kind), x.astype(kind)
            want = ((v[:, None] - e[None]) ** 2).sum(axis=2)
            best, away = codes.nearest(v, codes.slices(e))
            assert (best == want.astype(float).argmin(axis=1)).all() and (away == want.min(axis=1)).all()


@pytest.mark.parametrize("length", [32, 19, 3])
def test_codes(spark, length):
    rng = np.random.default_rng(length)
    rows = [(int(i), v.tolist(), int(i % 3) if i % 7 else None) for i, v in enumerate(rng.standard_normal((150, length)))]
    rows += [rows[9], rows[9], (None, rows[8][1], 1), (500, rows[7][1], None), (501, [0.0] * length, 1), (502, [1e30] * length, 2), (503, [-2e5] * length, 2), (3, [0.5] * length, 2)]
    rows += [(600, None, 1), (601, [float("nan")] * length, 1), (602, [None] * length, 1), (603, [float("inf")] * length, 1), (604, [1.0], 2), (605, [], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"id": F.lit("x"), "v": F.lit(1), "code.x": F.lit(0)}).repartition(4)
    want, digest = brute.codes(rows)
    coded, coder = codes.compress(df)
    assert coder.digest() == digest
    assert sorted(map(repr, (tuple(r)[:1] + tuple(r)[2:] for r in coded.collect()))) == sorted(repr((k, c, e)) for (k, _), (c, e, _) in want.items())


def test_codes_of_few_and_of_no_vectors(spark, tmp_path):
    few = spark.createDataFrame([(i, [float(i)] * 16, 0) for i in range(3)], "vec_id long, embedding array<double>, label int")
    for df in (few, few.filter("false"), few.select("vec_id", F.lit(None).cast("array<float>").alias("embedding"), "label")):
        df.write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
        got = queries.op12_codes(spark, str(tmp_path)).collect()
        assert len(got) == (3 if df is few else 0)
    coded = {r["id"]: r["code"] for r in codes.compress(few)[0].collect()}
    assert coded == {i: f"{i:02x}" * 16 for i in range(3)}


# --- licence notices ----------------------------------------------------------------------------------------


def edited(rng, text, edits):
    for _ in range(edits):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + text[i + 1:], text[:i] + rng.choice("aeé x") + text[i:], text[:i] + rng.choice("aeé x") + text[i + 1:]])
    return text


def test_notices(spark):
    rng = random.Random(2)
    words = "the mit license apache gnu general public cc by licence foo reserved quux é rights".split()
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [None, "", " \n", "MIT", "MIT License", "xMIT License", "mit  -- license", "mít license", "CC-BY cc by CC by-sa", "É" * 40]
    for notice in licenses.NOTICES:
        for e in range(6):
            texts.append(f"{text(5)} {edited(rng, notice, e)}, {text(3)}\n{edited(rng, notice.upper(), 1)}")
    texts += [text(40) for _ in range(40)]
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(texts)], "doc_id long, text string, k0 string, t int").withColumn("a.b", F.lit(1)).repartition(3)
    got = {r["doc_id"]: r for r in licenses.find_notices(df, ["doc_id", "a.b", "k0", "t", "text"]).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n, exact, near = brute.notices(t, licenses.BASE, licenses.NOTICES, licenses.allowed)
        r = got[i]
        assert (r["n_words"], r["a.b"], r["k0"], r["text"]) == (n, 1, "x", t)
        assert sorted((b["label"], b["start"]) for b in r["base"]) == sorted((licenses.BASE[p], w) for p, w in exact)
        found = {}
        for x in r["notices"]:
            assert 0 <= x["start"] < x["end"] <= n
            found[x["notice"]] = min(found.get(x["notice"], 99), x["edits"])
        assert found.keys() == near.keys(), (t, found, near)
        assert all(found[k] <= licenses.allowed(k) and found[k] >= near[k] for k in near)
        assert r["score"] == (1.0 if exact else max((1 - e / (licenses.allowed(k) + 1) for k, e in found.items()), default=0.0))
    assert licenses.find_notices(df.filter("false"), ["doc_id"]).count() == 0


def test_notices_do_not_depend_on_the_pieces_of_a_text():
    rng = random.Random(5)
    finder = licenses.Finder(list(licenses.NOTICES), list(licenses.BASE))
    for n in (0, 1, 30, 300):
        for _ in range(10):
            text = " ".join(edited(rng, rng.choice([*licenses.NOTICES, "foo", "é" * 300]), rng.randrange(3)) for _ in range(n))
            data = np.frombuffer(text.encode(), np.uint8)
            whole = finder.scan(data)
            assert all(finder.scan(data, piece=p) == whole for p in (1, 50, 1000))


def test_query_of_notices(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in entry.queries()["op13_licenses"](spark, SF).collect():
        n, exact, _ = brute.notices(texts[r["doc_id"]], licenses.BASE, [], licenses.allowed)
        starts = [w for _, w in exact]
        base = sorted({licenses.BASE[p] for p, _ in exact})
        assert tuple(r)[1:6] == (n, len(exact), min(starts, default=None), max(starts, default=None), ",".join(base))
        assert set(base) <= set(r["labels"].split(",")) and r["labels"].split(",") == sorted(set(r["labels"].split(","))) and 0 <= r["score"] <= 1
        assert math.isclose(r["score"], 1.0) or not base
