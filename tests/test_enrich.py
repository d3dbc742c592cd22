import hashlib
import json

import pytest
from pyspark.sql import functions as F

from gleanwork.operators import enrich
from gleanwork.plans import catalog, news, people
from gleanwork.sources import batches


def prompts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, p STRING").coalesce(1)


def upper(ps):
    return [p.upper() for p in ps]


def test_failing_prompt_only_marks_its_own_rows(spark):
    def infer(ps):
        if "bad" in ps:
            raise RuntimeError("x" * 200)
        return upper(ps)

    got = enrich.enrich(prompts(spark, ["a", "b", "bad", "c", None, "d"]), F.col("p"), infer, batch_size=2).orderBy("i").collect()
    assert [(r.response, r.error and len(r.error)) for r in got] == [
        ("A", None), ("B", None), (None, 200), ("C", None), (None, None), ("D", None)
    ]


def test_wrong_number_of_answers_is_an_error(spark):
    got = enrich.enrich(prompts(spark, ["a", "b"]), F.col("p"), lambda ps: ["x"] * (len(ps) + 1)).collect()
    assert {r.error for r in got} == {"2 answers for 1 prompts"}


def test_distinct_prompts_are_asked_once(spark, tmp_path):
    log = str(tmp_path / "log")

    def infer(ps):
        with open(log, "a") as f:
            f.write("".join(p + "\n" for p in ps))
        return upper(ps)

    df = prompts(spark, ["a", "b", "a", None, "a"])
    got = enrich.enrich_distinct(df, F.col("p"), infer).orderBy("i").collect()
    assert [r.response for r in got] == ["A", "B", "A", None, "A"]
    assert sorted(open(log).read().split()) == ["a", "b"]


def test_store_answers_survive_runs(spark, tmp_path):
    store, log = str(tmp_path / "answers"), str(tmp_path / "log")

    def infer(ps):
        with open(log, "a") as f:
            f.write("".join(p + "\n" for p in ps))
        if "fails" in ps:
            raise RuntimeError("down")
        return upper(ps)

    def run(values):
        got = enrich.enrich_with_store(prompts(spark, values), F.col("p"), infer, store, batch_size=1)
        return [(r.response, r.error) for r in got.orderBy("i").collect()]

    assert run(["a", "fails"]) == [("A", None), (None, "down")]
    assert run(["a", "b", "fails", "a"]) == [("A", None), ("B", None), (None, "down"), ("A", None)]
    assert sorted(open(log).read().split()) == ["a", "b", "fails", "fails"]


def test_two_pass_only_settles_negatives(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, False), (4, False), (5, None)], "k INT, first BOOLEAN")
    evidence = spark.createDataFrame([(1, False, "no"), (2, True, "yes"), (3, False, "no")], "k INT, supports BOOLEAN, evidence STRING")
    first = F.struct(F.col("first").alias("relevant"), F.when(F.col("k") == 4, "r4").alias("reason"))
    got = enrich.two_pass_verdict(df, first, evidence, "k").orderBy("k").collect()
    assert [(r.k, r.relevant, r.reason, r.verified) for r in got] == [
        (1, True, None, False), (2, True, "yes", True), (3, False, " (double‑checked on the web)", True),
        (4, False, "r4", False), (5, False, None, False),
    ]


BASE = [
    (1, "audio generation", "makes sound"), (2, ";video", "audio generation for all"), (3, None, "audiogeneration"),
    (4, ";a;audio generation;audio generation", "other"), (5, "x", None),
]
CASE = enrich.UseCase("audio generation", "audio generation", ("audio generation",))


def test_curate(spark):
    base = spark.createDataFrame(BASE, "tool_id INT, use_aggregated STRING, tool_description STRING")
    cohort, candidates = enrich.curate(base, CASE, "tool_id", enrich.judged_by(CASE))
    assert [(r.tool_id, r.relevant, r.use_aggregated) for r in cohort.orderBy("tool_id").collect()] == [(1, False, ""), (4, False, ";a")]
    assert [r.tool_id for r in candidates.collect()] == [2]

    def infer(ps):
        return [json.dumps({"relevant": "sound" in p, "reason": "asked"}) for p in ps]

    cohort, _ = enrich.curate(base, CASE, "tool_id", enrich.judged_by(CASE, infer))
    assert [(r.tool_id, r.relevant, r.reason) for r in cohort.orderBy("tool_id").collect()] == [(1, True, "asked"), (4, False, "asked")]
    with pytest.raises(Exception, match="Invalid response"):
        enrich.curate(base, CASE, "tool_id", enrich.judged_by(CASE, upper))[0].collect()


def test_flag_and_payload(spark):
    base = spark.createDataFrame(BASE, "tool_id INT, use_aggregated STRING, tool_description STRING")
    flagged = enrich.flag_use(base, "audio", "use_aggregated", "audio generation")
    got = json.loads(enrich.payload(flagged.select("tool_id", "audio"), "tool_id", 1).first().payload)
    assert got == [{"tool_id": 1, "audio": True}]
    ready = base.withColumn("audio", F.col("tool_id") == 5)
    assert [r.tool_id for r in enrich.flag_use(ready, "audio", "use_aggregated", "x").collect()] == [5]


def test_news_model_flow(spark):
    df = spark.createDataFrame(
        [(1, "Tool", "Tool news about valid"), (2, "Tool", "Tool launches broken"), (3, "Tool", "Tool x"), (4, "Tool", "Other headline here"), (5, "Tool", "Tool crash please")],
        "ord INT, tool_name STRING, title STRING",
    )

    def infer(ps):
        if any("crash" in p for p in ps):
            raise RuntimeError("down")
        return ['{"category": "funding", "company_relevance": true, "reasoning": "r"}' if "valid" in p else "?" for p in ps]

    judged = news.classify(df.coalesce(1), infer=lambda ps: [a for p in ps for a in _safe(infer, p)])
    assert sorted((r.ord, r.category) for r in judged.collect()) == [(1, "funding"), (2, "feature update"), (5, "news article")]


def _safe(infer, p):
    try:
        return infer([p])
    except RuntimeError:
        return [None]


def test_affiliations_by_model(spark):
    df = spark.createDataFrame([("A", "Acme"), ("B", " "), ("C", "Down Inc"), ("D", None)], "name STRING, affiliation STRING")

    def infer(ps):
        raise RuntimeError("no model")

    got = {r.name: (r.primary_affiliation, r.reasoning) for r in people.affiliations(df, infer).collect()}
    assert got["B"] == got["D"] == ("No affiliation provided", "Empty affiliation field")
    assert got["A"] == got["C"] == ("Extraction failed", "no model")


def test_translation_and_images(spark):
    df = spark.createDataFrame([("bonjour",), ("rien",)], "t STRING")

    def infer(ps):
        return [json.dumps({"response": "  hello", "total_duration": 5}) if "bonjour" in p else None for p in ps]

    assert [tuple(r) for r in enrich.translate(df, "t", infer).collect()] == [("bonjour", "hello", 5)]
    images = spark.createDataFrame([("a.png", "QQ=="), ("b.png", "Qg==")], "path STRING, payload STRING")
    got = enrich.describe_images(images, lambda ps: [" nice " if p == "QQ==" else "" for p in ps])
    assert sorted(tuple(r) for r in got.collect()) == [("a.png", "nice"), ("b.png", "Error: No content received")]


def test_catalogue_steps(spark):
    ranking = spark.createDataFrame([(1, "a", "r"), (None, "b", "r")], "tool_id INT, use_original STRING, tool_url STRING")
    profile = spark.createDataFrame(
        [(1, "x;y", "n", "p", "d"), (None, "z", "m", "q", "e")],
        "tool_id INT, use_aggregated STRING, name_tool STRING, tool_url STRING, tool_description STRING",
    )
    base = catalog.catalogue(ranking, profile)
    assert sorted(map(str, base.collect())) == sorted(map(str, base.collect())) and base.count() == 2
    assert [r.tool_url_y for r in base.filter("tool_id = 1").collect()] == ["p"]
    ids = spark.createDataFrame([(1,)], "tool_id INT")
    assert {r.tool_id: r.use_aggregated for r in catalog.remove_tags(base, ["x", "z"], ids).collect()} == {1: "y", None: "z"}
    assert {r.tool_id: r.use_aggregated for r in catalog.remove_tags(base, ["x", "z"]).collect()} == {1: "y", None: ""}


def test_known_use_cases(spark):
    base = spark.createDataFrame(
        [(1, "x;Software Development", None), (2, "gamingx", "an interview"), (3, None, "interviews"), (4, None, "legal assistance"), (5, None, "Risk & Compliance;x")],
        "tool_id INT, use_original STRING, use_aggregated STRING",
    )
    found = {n: [r.tool_id for r in catalog.cohort(base, n).collect()] for n in catalog.USE_CASES}
    assert {n: ids for n, ids in found.items() if ids} == {
        "software development": [1], "gaming": [2], "interviews & interview management": [2],
        "legal assistance": [4], "compliance management": [5],
    }


def test_answer_flag_of_a_use(spark):
    case = enrich.UseCase("u", "t", ("sound",), tag_column="use_aggregated", answer_flag="audio")
    base = spark.createDataFrame([(1, "sound", "makes sound")], "tool_id INT, use_aggregated STRING, tool_description STRING")
    judge = enrich.judged_by(case, lambda ps: ['{"audio": true}'] * len(ps))
    assert enrich.curate(base, case, "tool_id", judge)[0].first().use_aggregated == "sound;t"


def test_a_store_that_knows_all_prompts_is_left_as_it_is(spark, tmp_path):
    """Prompts are asked once; a run without new prompts moves none of them and adds no batch."""
    store = str(tmp_path / "answers")

    def run(prompts, infer):
        df = spark.createDataFrame(list(enumerate(prompts)), "id INT, p STRING")
        return sorted((r.id, r.response, r.error) for r in enrich.enrich_distinct(df, F.col("p"), infer, store=store, spread_by=["id"]).collect())

    def fail(prompts):
        raise ValueError("asked again")

    assert run(["a", "b", None, "a"], lambda ps: [p + "1" for p in ps]) == [(0, "a1", None), (1, "b1", None), (2, None, None), (3, "a1", None)]
    assert run(["b", None, "a", "a"], fail) == [(0, "b1", None), (1, None, None), (2, "a1", None), (3, "a1", None)]
    assert len(batches.attempts(spark, store)) == 1
    assert run(["c", "b", "c"], lambda ps: [p + "2" for p in ps]) == [(0, "c2", None), (1, "b1", None), (2, "c2", None)]
    assert run(["d"], fail) == [(0, None, "asked again")]
    assert run(["d", "a"], lambda ps: [p + "3" for p in ps]) == [(0, "d3", None), (1, "a1", None)]
    assert {r.digest: r.response for r in enrich.read_answers(spark, store).collect()} == {hashlib.sha256(k.encode()).hexdigest(): v for k, v in
                                                                                          {"a": "a1", "b": "b1", "c": "c2", "d": "d3"}.items()}
