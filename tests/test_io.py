import json
import os

import pytest
from pyspark.sql import functions as F

from gleanwork import lexicons as lx
from gleanwork import schemas
from gleanwork.session import shared_path
from gleanwork.sources import readers, writers
from gleanwork.streaming import crawl as streams


def test_url_column_discovery():
    assert readers.find_url_column(["a", "Page_URL", "url"]) == "Page_URL"
    assert readers.find_url_column(["a", "b"]) == "a"


def test_seed_fallbacks(spark, tmp_path):
    assert readers.read_seeds(spark, str(tmp_path / "none")).count() == 10
    df = spark.createDataFrame([(1, "B", "u"), (2, "A", "u"), (3, "B", "v"), (4, None, "w")], schemas.TOOL_SEED)
    writers.write_csv(df, str(tmp_path / "seeds"), ["tool_id", "tool_name", "tool_url"])
    assert [r.tool_name for r in readers.read_seeds(spark, str(tmp_path / "seeds")).collect()] == ["B", "A"]
    assert readers.inline_seeds(spark).count() == 26


def test_csv_null_rules(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('tool_id,tool_name,tool_url\n1,N/A,\n2,"a ""q"", b","x\ny"\n')
    got = readers.read_csv(spark, str(path), schemas.TOOL_SEED, multi_line=True).orderBy("tool_id").collect()
    assert [tuple(r) for r in got] == [(1, None, None), (2, 'a "q", b', "x\ny")]


def test_generations_skip_what_is_missing(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"backup_{i}.csv").write_text(f"url,name\nu{i},n\n")
    got = readers.read_generations(spark, str(tmp_path / "backup_*.csv"), "url STRING, name STRING")
    assert sorted((r.url, os.path.basename(r.file_path)) for r in got.collect()) == [("u1", "backup_1.csv"), ("u2", "backup_2.csv")]


def test_columns_are_read_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("tool_name,tool_id,tool_url\nAlpha,7,http://a\n")
    got = readers.read_csv(spark, str(tmp_path / "a.csv"), schemas.TOOL_SEED).collect()
    assert [(r.tool_id, r.tool_name, r.tool_url) for r in got] == [(7, "Alpha", "http://a")]
    (tmp_path / "b.csv").write_text("tool_id,tool_url\n1,u\n")
    with pytest.raises(ValueError, match="tool_name"):
        readers.read_csv(spark, str(tmp_path / "b.csv"), schemas.TOOL_SEED)
    assert readers.read_seeds(spark, str(tmp_path / "b.csv")).count() == 3


def test_garbage_seed_file_gives_the_fixed_names(spark, tmp_path):
    (tmp_path / "seeds").write_bytes(bytes(range(256)) * 40)
    assert readers.read_seeds(spark, str(tmp_path / "seeds")).count() == 3


def test_generations_of_other_layouts(spark, tmp_path):
    schema = "page_url STRING, product_name STRING"
    (tmp_path / "backup_1.csv").write_text("page_url,extra,product_name\nu1,x,P1\n")
    (tmp_path / "backup_2.csv").write_text("product_name,page_url\nP2,u2\n")
    (tmp_path / "backup_3.csv").write_text("page_url\nu3\n")
    (tmp_path / "backup_4.csv").write_bytes(b"\x00\xff\x10garbage\n\x01")
    path = str(tmp_path / "backup_*.csv")
    got = readers.read_generations(spark, path, schema).collect()
    assert {(r.page_url, r.product_name) for r in got} == {("u1", "P1"), ("u2", "P2"), ("u3", None)} and len(got) == 3
    assert [os.path.basename(r.file_path) for r in readers.rejected_files(spark, path, schema).collect()] == ["backup_4.csv"]


def test_sorted_csv(spark, tmp_path):
    out = tmp_path / "sorted"
    writers.write_csv(spark.range(1000).selectExpr("id * 7919 % 1000 AS n").repartition(6), str(out), ["n"], order_by=[F.desc("n")])
    lines = [x for part in sorted(out.glob("part-*.csv")) for x in part.read_text().split()[1:]]
    assert lines == [str(n) for n in range(999, -1, -1)]


def test_no_url_file_is_no_url(spark, tmp_path):
    assert readers.read_urls(spark, str(tmp_path / "none.csv")).count() == 0


def test_fixed_fields(spark):
    df = spark.createDataFrame([(1, "x")], "b INT, extra STRING")
    assert writers.select_fields(df, ["a", "b"]).first().asDict() == {"a": None, "b": 1}


def test_images_reports_and_json(spark, tmp_path):
    (tmp_path / "shot.one.png").write_bytes(b"AB")
    images = readers.read_images(spark, str(tmp_path / "*.png"))
    assert images.first().payload == "QUI="
    rows = images.select(F.lit("shot").alias("stem"), F.lit("shot.png").alias("name"), F.lit("body").alias("d"))
    writers.write_reports(rows, str(tmp_path / "reports"), "stem", "name", "d")
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "reports")).collect())
    assert text.startswith("AI Tool Website Analysis: shot.png\n====") and text.endswith("body")
    writers.write_json(spark.range(2), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    writers.write_cohort(spark.range(3), str(tmp_path / "cohorts"), "audio")
    assert readers.read_table(spark, str(tmp_path / "cohorts/audio"), "id BIGINT").count() == 3


def test_ledger_is_empty_before_the_first_run(spark, tmp_path):
    assert readers.read_ledger(spark, str(tmp_path / "ledger")).count() == 0


def test_unwrap_drops_responses_without_data(spark):
    bodies = [json.dumps({"data": [{"a": 1}, {"a": 2}]}), json.dumps({"x": 1}), "broken", None]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i INT, body STRING")
    assert [tuple(r) for r in readers.unwrap_data(df, "body", "a: INT").collect()] == [(0, 1), (0, 2)]


def test_shared_path_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = shared_path(spark, "x")
    assert path != shared_path(spark, "x")
    if base:
        assert path.startswith(base)


@pytest.fixture
def inbox(spark, tmp_path):
    path = str(tmp_path / "inbox")

    def put(rows):
        spark.createDataFrame(rows, "ord INT, url STRING, ts TIMESTAMP").coalesce(1).write.mode("append").parquet(path)

    return path, put


SCHEMA = "ord INT, url STRING, ts TIMESTAMP"


def test_restart_does_not_repeat(spark, tmp_path, inbox):
    import datetime

    path, put = inbox
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    t = datetime.datetime(2024, 1, 1)

    def run(event_time=None):
        stream = streams.stream_files(spark, path, SCHEMA)
        streams.append_snapshots(streams.first_seen(stream, "url", event_time), out, checkpoint).awaitTermination()
        return sorted(r.url for r in spark.read.parquet(out).collect())

    put([(1, "a", t), (2, "b", t), (3, "a", t)])
    assert run() == ["a", "b"]
    assert run() == ["a", "b"]
    put([(4, "a", t), (5, "c", t)])
    assert run() == ["a", "b", "c"]


def test_bounded_state_variant(spark, tmp_path, inbox):
    import datetime

    path, put = inbox
    t = datetime.datetime(2024, 1, 1)
    put([(1, "a", t), (2, "a", t + datetime.timedelta(hours=1)), (3, "b", t)])
    stream = streams.first_seen(streams.stream_files(spark, path, SCHEMA), "url", "ts", "1 day")
    streams.append_snapshots(stream, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "o")).collect()) == ["a", "b"]


def test_failed_urls_are_fetched_again(spark, tmp_path, inbox):
    import datetime

    path, put = inbox
    ledger, out, checkpoint = (str(tmp_path / p) for p in ("ledger", "out", "cp"))
    t = datetime.datetime(2024, 1, 1)

    def run(good):
        def fetch(todo):
            return todo.select("url", F.when(F.col("url").isin(*good), "completed").otherwise("failed").alias("status"))

        stream = streams.stream_files(spark, path, SCHEMA)
        streams.crawl_batches(stream, ledger, out, checkpoint, "url", "ord", fetch).awaitTermination()
        return sorted((r.url, r.status, r.run_id) for r in readers.read_ledger(spark, ledger).collect())

    put([(1, "a", t), (2, "b", t), (3, "a", t)])
    first = run(["a"])
    assert first == [("a", "completed", "0"), ("b", "failed", "0")]
    put([(4, "a", t), (5, "b", t)])
    assert run(["a", "b"]) == sorted([*first, ("b", "completed", "retry-0")])


def test_failed_urls_are_asked_again_without_new_requests(spark, tmp_path, inbox):
    import datetime

    path, put = inbox
    ledger, out, checkpoint = (str(tmp_path / p) for p in ("ledger", "out", "cp"))
    put([(1, "a", datetime.datetime(2024, 1, 1)), (2, "b", datetime.datetime(2024, 1, 1))])
    for good in (["a"], ["a"], ["a", "b"], ["a", "b"]):
        def fetch(todo, good=good):
            return todo.select("url", F.when(F.col("url").isin(*good), "completed").otherwise("failed").alias("status"))

        streams.crawl_batches(streams.stream_files(spark, path, SCHEMA), ledger, out, checkpoint, "url", "ord", fetch).awaitTermination()
    got = streams.latest_status(readers.read_ledger(spark, ledger)).collect()
    assert sorted(tuple(r) for r in got) == [("a", "completed", 1), ("b", "completed", 3)]


def test_sentinels(spark):
    df = spark.createDataFrame([(None, 1)], "image_url STRING, n INT")
    assert writers.with_sentinels(df, {"image_url": lx.NO_IMAGE, "absent": "x"}).first().image_url == "No Image"


def test_reports_are_one_file_a_key_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 40, 1, 4).selectExpr("concat('k', id % 10) AS k", "concat('n', id) AS name", "'b' AS body")
    path = str(tmp_path / "reports")
    writers.write_reports(rows, path, "k", "name", "body")
    files = spark.read.format("binaryFile").load(f"{path}/*/*.txt").select("path").collect()
    assert len(files) == 10
    assert len({f["path"].rsplit("/", 1)[1].split("-")[1] for f in files}) > 1


def test_images_of_many_folders_by_pattern(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"k={i}").mkdir()
        (tmp_path / f"k={i}" / "a.txt").write_bytes(b"A%d" % i)
        (tmp_path / f"k={i}" / "b.bin").write_bytes(b"x")
    got = readers.read_images(spark, str(tmp_path), "*.txt")
    assert got.columns == ["path", "payload"] and got.count() == 40 == got.select("payload").distinct().count()
    assert got.collect() != [] and readers.read_images(spark, f"{tmp_path}/*/*.txt").exceptAll(got).isEmpty()
