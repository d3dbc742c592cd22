import os
import random
import subprocess
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from gleanwork import schemas, workload
from gleanwork.functions import predicates
from gleanwork.operators import extract
from gleanwork.operators import page_specs as specs
from gleanwork.plans import crawl, news, people


def one(html, spec):
    return extract.page_records(html, spec)


def test_no_container_gives_no_rows():
    assert one("<p>nothing</p>", specs.ARTICLE_BASIC) == []
    assert one(None, specs.ARTICLE_BASIC) == []
    assert one("", specs.PRODUCT_PAGE) == [
        {"page_title": None, "product_name": None, "visit_href": None, "additional_url": None}
    ]


def test_first_container_kind_wins_for_the_page():
    page = "<div class='t_s'><a>second kind</a></div><div class='a news-card-body'><a>first kind</a></div>"
    assert [r["title"] for r in one(page, specs.ARTICLE_BASIC)] == ["first kind"]
    assert [r["title"] for r in one(page.replace("news-card-body", "other"), specs.ARTICLE_BASIC)] == ["second kind"]


def test_existing_node_wins_even_if_empty():
    page = "<div class='news-card'><a class='title'>Some title</a><div class='source'> </div><span class='source'>S</span></div>"
    row = one(page, specs.ARTICLE_ADVANCED)[0]
    assert (row["source"], row["snippet"], row["link"], row["image_url"]) == ("", "No Snippet", "No Link", "No Image")


def test_title_cascade_prefers_class_then_news_link():
    page = "<article class='news-card'><a href='/x'>plain</a><a href='/news/1'>news</a>{}</article>"
    assert one(page.format(""), specs.ARTICLE_ADVANCED)[0]["title"] == "news"
    got = one(page.format("<A CLASS='title' HREF='/t?a=1&amp;b=2'>titled</A>"), specs.ARTICLE_ADVANCED)[0]
    assert (got["title"], got["link"]) == ("titled", "/t?a=1&b=2")


def test_markup_is_read_leniently():
    page = (
        "<script>var a = '<div class=t_s><a>fake</a></div></p>';</script><!-- <div class=t_s>no</div> -->"
        "<div class='t_s'><p>one<br>two<p>three</b></i><a href='/x'>A &lt;b&gt; <script>x()</script>c</a>"
    )
    assert [(r["title"], r["link"]) for r in one(page, specs.ARTICLE_BASIC)] == [("A <b> c", "/x")]


def test_product_fields():
    page = (
        "<title> A\n B </title><h1>  </h1><div class='product-name'>Name</div>"
        "<a href='/go' target='_blank'>Visit us</a><span class='font-semibold truncate'>not one</span>"
    )
    got = one(page, specs.PRODUCT_PAGE)[0]
    assert got == {"page_title": "A B", "product_name": "Name", "visit_href": "/go", "additional_url": None}
    got = one("<a href=''>Visit website</a><a href='http://e/?ref=producthunt'>x</a>", specs.PRODUCT_PAGE)[0]
    assert got["visit_href"] == "http://e/?ref=producthunt"


def test_product_rows(spark):
    pages = spark.createDataFrame(
        [("https://h.x/p/a", "<h1>N</h1><a href='go'>visit WEBSITE</a>"), ("https://h.x/signin", "<h1>N</h1>"), ("https://h.x/n", None)],
        "url STRING, html STRING",
    )
    got = {r.url: (r.product_name, r.visit_website_url, r.page_status) for r in crawl.product_rows(pages).collect()}
    assert got == {
        "https://h.x/p/a": ("N", "https://h.x/p/go", "ok"), "https://h.x/signin": ("N", None, "login"),
        "https://h.x/n": (None, None, "ok"),
    }


def test_reviews_need_the_direct_parent(spark):
    page = (
        "<h1 class='color-darker-grey'>T</h1><div class='flex direction-row'><p><span class='color-lighter-grey "
        "fontSize-14 fontWeight-400'>Recently (9 reviews)</span></p></div><div id='review-1'></div><div id='preview-2'></div>"
    )
    df = spark.createDataFrame([("u", page), ("v", "<h1>none</h1>")], "url STRING, html STRING")
    assert crawl.review_rows(df).columns == [c.split()[0] for c in schemas.REVIEW.split(", ")]
    got = crawl.review_rows(df).collect()
    assert [(r.review_id, r.tool_name, r.recent_reviews_amount, r.helpful_count, r.product_url) for r in got] == [
        ("review-1", "T", "N/A", "0", "u")
    ]


CARD = (
    "<div class='gsc_1usr'><h3 class='gs_ai_name'><a href='/c?u=1'>Ada <b>L.</b></a></h3><div class='gs_ai_aff'>X\x01Y</div>"
    "<div class='gs_ai_int'><a class='gs_ai_one_int'>a</a><a class='gs_ai_one_int'>b</a></div><img src='s' alt='t'></div>"
)


def test_profiles(spark):
    df = spark.createDataFrame([("l", 1, 2, CARD), ("m", 1, 2, "<div class='xx scholar'><a>No link</a></div>")],
                               "label STRING, tab_index INT, page_number INT, html STRING")
    got = {r.label: r for r in people.profile_rows(df).collect()}
    assert (got["l"].name, got["l"].profile_url, got["l"].affiliation, got["l"].research_interests) == (
        "AdaL.", "https://scholar.google.com/c?u=1", "XY", "a, b"
    )
    assert (got["m"].name, got["m"].profile_url, got["m"].research_interests) == ("No link", "N/A", "N/A")
    labelled = people.labelled_profile_rows(df, "'now'").collect()
    assert [(r.label, r.name, r.interests, r.profile_picture_alt, r.scraped_at) for r in labelled] == [
        ("l", "Ada L.", "a; b", "t", "now")
    ]


def test_affiliation_falls_back_to_the_first_plain_div():
    card = "<div class='gsc_1usr'><h3>N</h3><div><i>a</i> b</div><div></div><div><b> Only <!-- x --></b></div><div><b>Wrapped</b></div></div>"
    assert one(card, specs.PROFILES)[0]["affiliation"] == "Wrapped"
    assert one("<div class='gsc_1usr'><h3> A <!-- c --> B &amp; 1 < 2 </h3></div>", specs.PROFILES)[0]["name"] == "AB & 1 < 2"


def test_only_html_crosses_into_python(spark):
    pages = spark.createDataFrame([(1, "u", CARD, "wide")], "page_id INT, url STRING, html STRING, other STRING")
    plan = extract.extract_records(pages, specs.PROFILES).select("page_id", "name")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in text and "BatchEvalPython" not in text
    assert "other" not in text.split("ArrowEvalPython")[0]


def test_workers_need_no_copy_of_the_package():
    code = "import sys; from pyspark import cloudpickle; print(cloudpickle.loads(sys.stdin.buffer.read())())"
    job = cloudpickle.dumps(lambda: extract.page_records("<title>T</title>", specs.TOOL_NAME_PAGE))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], input=job, capture_output=True, cwd="/", env=env, check=True)
    assert done.stdout.decode().strip() == "[{'page_title': 'T', 'tool_name': 'N/A'}]"


def test_pages_without_containers_skip_the_tree_safely(spark):
    pages = [
        "<div class='t_s'><a>plain text</a></div>", "<div class='t&#95;s'><a>numeric</a></div>",
        "<div title='a>b' class='t&lowbar;s'><a>named</a></div>", "<div class='ts'><a>none &amp; nothing</a></div>",
    ]
    df = spark.createDataFrame([(p,) for p in pages], "html STRING")
    got = extract.extract_records(df, specs.ARTICLE_BASIC).collect()
    assert sorted(r.title for r in got) == ["named", "numeric", "plain text"]


def test_links_match_the_tree(spark):
    page = "<!-- <a href='x'>no</a> --><a class='c' href=\"/a?b=1\">T <b>x</b></a><script>'<a href=\"/s\">s</a>'</script>"
    df = spark.createDataFrame([(page,)], "html STRING")
    got = df.select(F.explode(extract.links_column(F.col("html"))).alias("l")).select("l.*").collect()
    assert [tuple(r) for r in got] == [("/a?b=1", "T <b>x</b>")]
    page = "<a href='/s?x=1&amp;y'>s</a><a id=i href=/bare>b</a><A HREF = \"/d\" >d</A><a data-href='no' href='yes'>y</a><a data-href='no'>n</a><a href=''>e</a>"
    df = spark.createDataFrame([(page,)], "html STRING")
    got = df.select(F.explode(extract.links_column(F.col("html"))).alias("l")).select("l.*").collect()
    assert [tuple(r) for r in got] == [("/s?x=1&y", "s"), ("/bare", "b"), ("/d", "d"), ("yes", "y"), ("", "e")]


def test_news_run_without_any_mention_keeps_all_as_irrelevant(spark):
    rows = [(i, "Tool", f"Some headline {i}", None, None) for i in range(3)]
    df = spark.createDataFrame(rows, "ord INT, tool_name STRING, title STRING, snippet STRING, image_url STRING")
    got = news.news_run(df, "ord", keep_all_when_none=True).collect()
    assert [(r.category, r.company_relevance) for r in got] == [("irrelevant", False)] * 3
    named = df.union(spark.createDataFrame([(9, "Tool", "tool raises a round", None, "/i")], df.schema))
    assert news.news_run(df, "ord").count() == 0
    got = news.news_run(named, "ord", keep_all_when_none=True).collect()
    assert [(r.ord, r.category, r.has_image) for r in got] == [(9, "funding", True)]


def test_people_run_with_a_model(spark):
    def infer(prompts):
        return ['{"companies": ["C"], "universities": [], "primary_affiliation": "p", "reasoning": "r"}'] * len(prompts)

    pages = spark.createDataFrame([(CARD,), (CARD.replace("gs_ai_aff", "x").replace("X\x01Y", "N/A"),)], "html STRING")
    got = people.people_run(pages, infer).collect()
    assert sorted((r.primary_affiliation, r.companies) for r in got) == [("No affiliation provided", []), ("p", ["C"])]


def test_output_rows_have_the_fixed_columns(spark):
    df = spark.createDataFrame([(1, "Tool", "u", "tool raises a round", None, None, None, None)],
                               "tool_id INT, tool_name STRING, tool_url STRING, title STRING, link STRING, image_url STRING, source STRING, snippet STRING")
    got = news.output_rows(news.classify(news.features(df)).withColumn("extra", F.lit(1))).first().asDict()
    assert (got["link"], got["snippet"], got["ollama_category"]) == ("No Link", "No Snippet", "funding")
    assert "extra" not in got


def test_empty_attributes_of_a_profile_count_as_missing(spark):
    html = '<div class="gsc_1usr"><h3 class="gs_ai_name"><a href="">Ann</a></h3><img src=""></div>'
    row = people.profile_rows(spark.createDataFrame([(html,)], "html STRING")).first()
    assert (row.name, row.profile_url, row.image_url) == ("Ann", "N/A", "N/A")


def test_a_robots_meta_tag_is_no_challenge(spark):
    html = '<html><head><meta name="robots" content="index"><title>T</title></head><body><h1>Tool</h1></body></html>'
    pages = spark.createDataFrame([("u", html)], "url STRING, html STRING")
    assert crawl.product_rows(pages).first().page_status == "ok"
    status = predicates.page_status(F.col("url"), F.lit("T"), F.lit("Tool"), F.col("html"))
    assert pages.select(status.alias("s")).first().s == "ok"


_PARTS = ['<div class="gsc_1usr x">', "<p>", "</p>", "</div>", "</b>", "<b>", "<br>", "<br/>", "<A HREF='/u'>", "</a >", "</A>", '<h3 class="gs_ai_name gs_ai_name" id=7>',
          '<div class="gs_ai_aff" class="y">', "<!-- c -->", "<script>var a='<b>';</script>", "<title>a<b></title>", " text > ", "a\n b", "&amp;", "x & y", "<", "< b", "<p ", "é", "\0",
          '<img src="" alt>', "<img src=' a b '>", "<template>t", "</template>", '<a data-x="1" title="a>b">', "<div\n class='gs_ai'>", '<div  id="r">', "<i class='gs_ai_int'>",
          '<a class="gs_ai_one_int" href="/x y\'z" class="k k">', '<div id="review-1" class="c">', '<a href="/1"target="_blank">', '<a href="/1" Target="_blank">', '</p class="x" id="y">', '<a href="x" b=\'"\'>']


def test_plain_pages_are_read_as_by_the_library(monkeypatch):
    """The same records whether a page is cut at its tags or read by the parser of the library."""
    rng = random.Random(3)
    kinds = [specs.PROFILES, specs.REVIEWS, specs.PRODUCT_PAGE, specs.ARTICLE_ADVANCED]
    tags = [p for p in _PARTS if extract._plain_tag(p)]
    assert {'<div class="gsc_1usr x">', "<A HREF='/u'>", "<br>", "</A>"} <= set(tags) and "<br/>" not in tags
    pages = ["".join(rng.choices(some, k=rng.randrange(1, 25))) for some in (_PARTS, [*tags, " a ", "b > c"]) for _ in range(3000)]
    for spec in kinds:
        fast = [extract.page_records(p, spec) for p in pages]
        with monkeypatch.context() as m:
            m.setattr(extract._Page, "_read_plain", lambda self, html: False)
            assert [extract.page_records(p, spec) for p in pages] == fast


def test_records_of_many_pages_in_slices(spark):
    """A batch is worked on in slices; nulls and pages without records keep their place."""
    rows = spark.range(0, 700, 1, 1).selectExpr(
        "id", "CASE WHEN id % 5 = 0 THEN NULL WHEN id % 7 = 0 THEN '<p>' ELSE concat('<div class=\"gsc_1usr\"><h3>n', id, '</h3></div>') END AS html")
    got = extract.extract_records(rows, specs.PROFILES).select("id", "name").collect()
    assert sorted((r.id, r.name) for r in got) == [(i, f"n{i}") for i in range(700) if i % 5 and i % 7]
    assert max(1, extract._PAGES) < 700


def test_listing_pages_are_parsed_by_all_cores(spark, tmp_path):
    """A table in one file must not be parsed by one task."""
    spark.range(64).selectExpr("id AS c_custkey", "concat('c', id) AS c_name", "'HOUSEHOLD' AS c_mktsegment", "1 AS c_nationkey", "6000.0D AS c_acctbal") \
        .coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    for name in ("profile_cards", "people_run"):
        df = workload.queries()[name](spark, str(tmp_path))
        assert df.rdd.getNumPartitions() >= min(8, spark.sparkContext.defaultParallelism) and df.count() == 64
