"""News queries."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from gleanwork import lexicons as lx
from gleanwork.functions import predicates, rules, text, urls
from gleanwork.operators import aggregates, dedup, enrich, extract, joins, keywords, ordinals, page_specs
from gleanwork.plans import news
from gleanwork.session import shared_path
from gleanwork.sources import readers, writers
from gleanwork.workload import views as v
from gleanwork.workload.registry import (
    query, sql_any, sql_occurrences, sql_presence, sql_rate, sql_strip, spread_table,
    table,
)

_WORDS = {"funding_words": v.FUNDING_WORDS, "feature_words": v.FEATURE_WORDS}


def _classify_sql(title: str, name: str, funding, feature, gate: bool = True) -> str:
    """(category, company_relevance, reasoning) CASE arms as one struct expression."""
    short = (
        f"WHEN length({sql_strip(f'coalesce({title}, chr(0)[1:0])')}) < {lx.GATE_TITLE_CHARS} "
        "THEN {'c': 'news article', 'r': false, 'w': 'Title too short'}" if gate else ""
    )
    return f"""CASE {short}
      WHEN NOT coalesce(contains(lower({title}), lower({name})), false)
        THEN {{'c': 'irrelevant', 'r': false, 'w': 'Tool name not found in title'}}
      WHEN {sql_any(f'lower({title})', funding)}
        THEN {{'c': 'funding', 'r': true, 'w': 'Funding-related keywords found'}}
      WHEN {sql_any(f'lower({title})', feature)}
        THEN {{'c': 'feature update', 'r': true, 'w': 'Feature update keywords found'}}
      ELSE {{'c': 'news article', 'r': true, 'w': 'General tool news'}} END"""


_FEATURES_SQL = f"""
  length(coalesce(title, ''))::INTEGER AS title_length,
  length(coalesce(snippet, ''))::INTEGER AS snippet_length,
  image_url IS NOT NULL AS has_image,
  {sql_presence('title', v.POSITIVE_WORDS)} AS positive_words,
  {sql_presence('title', v.NEGATIVE_WORDS)} AS negative_words,
  {sql_presence('title', v.POSITIVE_WORDS)} - {sql_presence('title', v.NEGATIVE_WORDS)} AS sentiment_score
"""


@query(f"WITH {v.ARTICLES_SQL} SELECT ord, {_FEATURES_SQL} FROM articles")
def article_features(spark, sf_dir):
    rows = news.features(v.articles(spark, sf_dir), v.POSITIVE_WORDS, v.NEGATIVE_WORDS)
    return rows.select(
        "ord", "title_length", "snippet_length", "has_image", "positive_words", "negative_words",
        "sentiment_score",
    )


_DECODED = "title"
for _entity, _char in lx.HTML_ENTITIES:
    _DECODED = f"replace({_DECODED}, '{_entity}', '{_char.replace(chr(39), chr(39) * 2)}')"


@query(f"""
WITH {v.ARTICLES_SQL}, t AS (SELECT ord, replace(title, ' the ', ' &lt;the&amp;amp; ') AS title, timestamp FROM articles)
SELECT ord, {_DECODED} AS cleaned_title, timestamp IS NOT NULL AS has_timestamp,
  {sql_occurrences('title', v.POSITIVE_WORDS)} AS positive_words,
  {sql_occurrences('title', v.NEGATIVE_WORDS)} AS negative_words,
  {sql_occurrences('title', v.POSITIVE_WORDS)} - {sql_occurrences('title', v.NEGATIVE_WORDS)} AS sentiment_score
FROM t""")
def article_features_occurrence(spark, sf_dir):
    marked = v.articles(spark, sf_dir).withColumn(
        "title", F.replace("title", F.lit(" the "), F.lit(" &lt;the&amp;amp; "))
    )
    rows = news.features_advanced(marked, v.POSITIVE_WORDS, v.NEGATIVE_WORDS)
    return rows.select("ord", "cleaned_title", "has_timestamp", "positive_words", "negative_words", "sentiment_score")


@query(f"""
WITH {v.ARTICLES_SQL} SELECT company, count(*) AS n, count(link) AS links, count(image_url) AS images,
  sum(length(title))::BIGINT AS title_chars, sum({sql_occurrences('title', v.POSITIVE_WORDS)})::BIGINT AS positive_words
FROM articles WHERE title <> '' AND title <> 'N/A' GROUP BY company""")
def advanced_file(spark, sf_dir):
    """Rows written with the fixed advanced column list and read back by it."""
    rows = news.features_advanced(v.articles(spark, sf_dir), v.POSITIVE_WORDS, v.NEGATIVE_WORDS)
    path = shared_path(spark, "advanced")
    writers.write_csv(rows.withColumn("page", F.lit(1)), path, lx.ARTICLE_ADVANCED_FIELDS)
    kinds = {"page": "INT", "title_length": "INT", "snippet_length": "INT", "has_image": "BOOLEAN", "has_timestamp": "BOOLEAN",
             "positive_words": "INT", "negative_words": "INT", "sentiment_score": "INT"}
    ddl = ", ".join(f"{c} {kinds.get(c, 'STRING')}" for c in lx.ARTICLE_ADVANCED_FIELDS)
    back = readers.read_csv(spark, path, ddl).filter("title IS NOT NULL")
    return back.groupBy("company").agg(
        F.count("*").alias("n"), F.count("link").alias("links"), F.count("image_url").alias("images"),
        F.sum("title_length").alias("title_chars"), F.sum("positive_words").alias("positive_words"),
    )


@query(f"""
WITH {v.ARTICLES_SQL}, e AS (SELECT ord, {sql_occurrences('title', lx.POSITIVE_WORDS)} AS p,
  {sql_presence('title', lx.POSITIVE_WORDS)} AS pp, {sql_presence('title', lx.NEGATIVE_WORDS)} AS np FROM articles)
SELECT p AS positive_occurrences, pp AS positive_words, np AS negative_words, count(*) AS n FROM e GROUP BY ALL""")
def sentiment_default_words(spark, sf_dir):
    title = F.col("title")
    return v.articles(spark, sf_dir).select(
        text.occurrence_count(title, lx.POSITIVE_WORDS).alias("positive_occurrences"),
        text.presence_count(title, lx.POSITIVE_WORDS).alias("positive_words"),
        text.presence_count(title, lx.NEGATIVE_WORDS).alias("negative_words"),
    ).groupBy("positive_occurrences", "positive_words", "negative_words").agg(F.count("*").alias("n"))


@query(f"WITH {v.ARTICLES_SQL} SELECT min(ord) AS ord, title FROM articles GROUP BY title")
def title_dedup_exact(spark, sf_dir):
    return dedup.dedup_exact_title(v.articles(spark, sf_dir), "title", "ord").select("ord", "title")


_VARIED = "CASE WHEN ord % 2 = 1 THEN concat('  ', translate(title, 'ETAON', 'etaon'), ' ') ELSE title END"


@query(f"""WITH {v.ARTICLES_SQL}, a AS (SELECT ord, {_VARIED} AS title FROM articles) SELECT ord, title FROM a
QUALIFY row_number() OVER (PARTITION BY {sql_strip('lower(title)')} ORDER BY ord) = 1""")
def title_dedup_normalized(spark, sf_dir):
    """Half of the titles with other cases and blanks around."""
    rows = v.articles(spark, sf_dir).withColumn("title", F.expr(_VARIED))
    return dedup.dedup_normalized_title(rows, "title", "ord").select("ord", "title")


def _rules_query(spark, sf_dir, **words):
    rows = v.articles(spark, sf_dir).withColumn("r", rules.classify_title(F.col("title"), F.col("tool_name"), **words))
    return rows.select("ord", "r.category", "r.company_relevance", "r.reasoning")


@query(f"""WITH {v.ARTICLES_SQL}, j AS (SELECT ord, {_classify_sql('title', 'tool_name', lx.TITLE_FUNDING_WORDS, lx.TITLE_FEATURE_WORDS)} AS j FROM articles)
SELECT ord, j.c AS category, j.r AS company_relevance, j.w AS reasoning FROM j""")
def classify_rules(spark, sf_dir):
    return _rules_query(spark, sf_dir)


@query(f"""WITH {v.ARTICLES_SQL}, j AS (SELECT ord, {_classify_sql('title', 'tool_name', v.FUNDING_WORDS, v.FEATURE_WORDS)} AS j FROM articles)
SELECT ord, j.c AS category, j.r AS company_relevance, j.w AS reasoning FROM j""")
def classify_rules_words(spark, sf_dir):
    return _rules_query(spark, sf_dir, **_WORDS)


def _answer_sql(text_expr: str, funding, feature) -> str:
    t = sql_strip(f"lower({text_expr})")
    quoted = lambda ws: ", ".join(f"'{w}'" for w in ws)
    return f"""CASE WHEN {t} IN ({quoted(lx.ANSWER_FEATURE_ALIASES)}) THEN 'feature update'
      WHEN {t} IN ({quoted(lx.ANSWER_FUNDING_ALIASES)}) THEN 'funding'
      WHEN {t} IN ({quoted(lx.ANSWER_NEWS_ALIASES)}) THEN 'news article'
      WHEN {sql_any(t, funding)} THEN 'funding'
      WHEN {sql_any(t, feature)} THEN 'feature update' ELSE 'news article' END"""


@query(f"""SELECT conv_id, turn,
  {_answer_sql('text', lx.ANSWER_FUNDING_WORDS, lx.ANSWER_FEATURE_WORDS)} AS category,
  {_answer_sql('text', v.FUNDING_WORDS, v.FEATURE_WORDS)} AS category_words,
  {_answer_sql("' ' || CASE role WHEN 'user' THEN 'Fund ' ELSE 'UPDATE' END", lx.ANSWER_FUNDING_WORDS, lx.ANSWER_FEATURE_WORDS)} AS category_alias
FROM conversations""")
def answer_normalizer(spark, sf_dir):
    alias = F.concat(F.lit(" "), F.when(F.col("role") == "user", "Fund ").otherwise("UPDATE"))
    return spread_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").select(
        "conv_id", "turn",
        rules.normalize_answer(F.col("text")).alias("category"),
        rules.normalize_answer(F.col("text"), v.FUNDING_WORDS, v.FEATURE_WORDS).alias("category_words"),
        rules.normalize_answer(alias).alias("category_alias"),
    )


_NEWS_SQL = f"""
WITH {v.ARTICLES_SQL},
firsts AS (SELECT * FROM articles QUALIFY row_number() OVER (PARTITION BY title ORDER BY ord) = 1),
judged AS (SELECT *, {_classify_sql('title', 'tool_name', v.FUNDING_WORDS, v.FEATURE_WORDS)} AS j
  FROM firsts WHERE contains(lower(title), lower(tool_name))),
news AS (SELECT ord, tool_name, title, {_FEATURES_SQL}, j.c AS category, j.r AS company_relevance
  FROM judged WHERE j.r)
"""


@query(_NEWS_SQL + "SELECT * FROM news")
def news_rows(spark, sf_dir):
    rows = news.news_run(v.articles(spark, sf_dir), "ord", **_WORDS)
    rows = news.features(rows, v.POSITIVE_WORDS, v.NEGATIVE_WORDS)
    return rows.select(
        "ord", "tool_name", "title", "title_length", "snippet_length", "has_image", "positive_words",
        "negative_words", "sentiment_score", "category", "company_relevance",
    )


@query(_NEWS_SQL + f"""SELECT category, count(*) AS n, count(*) FILTER (company_relevance) AS relevant,
  {sql_rate('count(*) FILTER (company_relevance)', 'count(*)')} AS relevant_ratio FROM news GROUP BY category""")
def news_by_category(spark, sf_dir):
    rows = news.news_run(v.articles(spark, sf_dir), "ord", **_WORDS)
    return aggregates.category_distribution(rows, "category", "company_relevance")


@query(_NEWS_SQL + """, c AS (SELECT (SELECT count(*) FROM articles) AS collected, (SELECT count(*) FROM firsts) AS unique_titles,
  (SELECT count(*) FROM judged) AS naming_tool, (SELECT count(*) FROM news) AS relevant)
SELECT *, unique_titles - naming_tool AS filtered_before, naming_tool - relevant AS filtered_after FROM c""")
def news_run_counts(spark, sf_dir):
    return news.run_counts(v.articles(spark, sf_dir), "ord", **_WORDS)


@query(f"""WITH {v.ARTICLES_SQL} SELECT company, count(*) AS n FROM articles GROUP BY company""")
def company_frequency(spark, sf_dir):
    return aggregates.frequency(v.articles(spark, sf_dir), "company")


@query(f"""WITH {v.ARTICLES_SQL}, j AS (SELECT {_classify_sql('title', 'tool_name', v.FUNDING_WORDS, v.FEATURE_WORDS)} AS j FROM articles)
SELECT j.c AS category, count(*) AS n, count(*) FILTER (j.r) AS relevant,
  {sql_rate('count(*) FILTER (j.r)', 'count(*)')} AS relevant_ratio FROM j GROUP BY 1""")
def category_distribution(spark, sf_dir):
    return aggregates.category_distribution(_rules_query(spark, sf_dir, **_WORDS), "category", "company_relevance")


@query(f"""
WITH {v.ARTICLES_SQL},
f AS (SELECT company, {_FEATURES_SQL}, timestamp IS NOT NULL AS has_timestamp FROM articles),
c AS (SELECT company, count(*) AS n FROM f GROUP BY company ORDER BY n DESC, company LIMIT 5)
SELECT count(*) AS total_articles, count(DISTINCT company) AS companies_covered,
  count(*) FILTER (has_image) AS articles_with_images,
  count(*) FILTER (has_timestamp) AS articles_with_timestamps,
  {sql_rate('sum(title_length)', 'count(*)')} AS avg_title_length,
  {sql_rate('sum(snippet_length)', 'count(*)')} AS avg_snippet_length,
  {sql_rate('sum(sentiment_score)', 'count(*)')} AS avg_sentiment_score,
  (SELECT string_agg(company || '=' || n, ', ' ORDER BY n DESC, company) FROM c) AS top_companies
FROM f""")
def news_summary(spark, sf_dir):
    rows = news.features(v.articles(spark, sf_dir), v.POSITIVE_WORDS, v.NEGATIVE_WORDS)
    rows = rows.withColumn("has_timestamp", text.is_present(F.col("timestamp"), lx.NO_TIMESTAMP))
    shown = F.transform("top_companies", lambda t: F.concat_ws("=", t["company"], t["n"].cast("string")))
    return news.run_summary(rows).withColumn("top_companies", F.array_join(shown, ", "))


@query("""SELECT tool_name FROM (SELECT source || '/' || lang AS tool_name, min(doc_id) AS first_id FROM documents
  WHERE lang <> 'es' GROUP BY 1) ORDER BY first_id LIMIT 100""")
def seed_names(spark, sf_dir):
    """The first distinct names of a seed file; rows without a name are skipped."""
    rows = table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS tool_id", "CASE WHEN lang <> 'es' THEN concat(source, '/', lang) END AS tool_name",
        "concat('https://', source, '.example.com') AS tool_url",
    )
    path = shared_path(spark, "seeds")
    writers.write_csv(rows, path, ["tool_id", "tool_name", "tool_url"])
    return readers.read_seeds(spark, path, n=100)


@query(f"""WITH {v.ARTICLES_SQL}, c AS (SELECT company, count(*) AS n FROM articles GROUP BY company ORDER BY n DESC, company LIMIT 5)
SELECT (SELECT count(*) FROM articles) AS total_articles, company, n FROM c""")
def summary_document(spark, sf_dir):
    """The run summary written as JSON and read back, one row per top company."""
    rows = news.features(v.articles(spark, sf_dir)).withColumn("has_timestamp", F.lit(False))
    path = shared_path(spark, "summary")
    writers.write_json(news.run_summary(rows), path)
    back = spark.read.schema("total_articles BIGINT, top_companies ARRAY<STRUCT<company: STRING, n: BIGINT>>").json(path)
    return back.select("total_articles", F.inline("top_companies"))


# --- filters ---------------------------------------------------------------------------------


@query("SELECT doc_id FROM documents WHERE contains(lower(text), 'queé') OR contains(lower(text), 'keit')")
def keyword_filter_any(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.filter(predicates.any_keyword(F.col("text"), ["QUEÉ", "keit"])).select("doc_id")


@query("SELECT doc_id FROM documents WHERE contains(text, 'The') OR contains(text, 'Éa')")
def keyword_filter_case_sensitive(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.filter(predicates.any_keyword(F.col("text"), ["The", "Éa"], case_sensitive=True)).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE regexp_matches(lower(text), '{predicates.word_pattern(['the by', 'que', 'e.n'])}')")
def keyword_filter_word(spark, sf_dir):
    docs = spread_table(spark, sf_dir, "documents", "doc_id", "text")
    return docs.filter(predicates.any_word(F.col("text"), ["The by", "que", "e.n"])).select("doc_id")


_WORDS_SQL = r"regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}_]+')"


@query(f"""
WITH t AS (SELECT DISTINCT lower(p_name) AS term FROM part
  UNION SELECT DISTINCT w FROM (SELECT unnest({_WORDS_SQL.format('text')}) AS w FROM benchmark) WHERE w <> ''),
w AS (SELECT doc_id, unnest(list_distinct({_WORDS_SQL.format('text')})) AS term FROM documents)
SELECT term, count(*) AS n FROM w JOIN t USING (term) WHERE term <> '' GROUP BY term""")
def keyword_table_hits(spark, sf_dir):
    bench = table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), keywords.SPLIT)).alias("term"))
    parts = table(spark, sf_dir, "part").select(F.lower("p_name").alias("term"))
    terms = bench.unionByName(parts).filter("term <> ''").distinct()
    docs = spread_table(spark, sf_dir, "documents", "doc_id", "text")
    hits = keywords.match_terms(docs, "doc_id", "text", terms)
    return hits.groupBy("term").agg(F.count("*").alias("n"))


#: Lengths of the substrings that are looked for.
_GRAMS = (8, 10)


def _grams_sql(table_name: str, columns: str) -> str:
    parts = [f"SELECT DISTINCT {columns} lower(substr(text, i::INTEGER, {n})) AS term FROM (SELECT *, unnest(range(1, length(text) - {n - 2})) AS i FROM {table_name})" for n in _GRAMS]
    return " UNION ".join(parts)


@query(f"""WITH t AS ({_grams_sql('benchmark', '')}), d AS ({_grams_sql('documents', 'doc_id,')})
SELECT term, count(*) AS n FROM d JOIN t USING (term) GROUP BY term""")
def substring_table_hits(spark, sf_dir):
    """In how many documents each substring of a test item stands: tens of thousands of terms."""
    items = table(spark, sf_dir, "benchmark").select("text")
    placed = items.filter(F.length("text") >= max(_GRAMS)).select("text", F.explode(F.sequence(F.lit(1), F.length("text"))).alias("i"))
    cut = placed.select(F.explode(F.array(*[F.substr(F.col("text"), F.col("i"), F.lit(n)) for n in _GRAMS])).alias("term"))
    terms = cut.filter(F.length("term").isin(*_GRAMS)).select(F.lower("term").alias("term")).distinct()
    docs = spread_table(spark, sf_dir, "documents", "doc_id", "text")
    return keywords.match_substrings(docs, "doc_id", "text", terms).groupBy("term").agg(F.count("*").alias("n"))


_LONGEST_SQL = "list_sort(list_transform(regexp_split_to_array(lower(text), '[^a-z]+'), lambda w: [lpad((1000 - length(w))::VARCHAR, 4, '0'), w]))[1][2]"
_PATTERN_SQL = f"DISTINCT left(w, 4) || '[a-z]+' || right(w, 2) || '|' || left(w, 5) || '.' || substr(w, 7, 2) AS pattern FROM (SELECT {_LONGEST_SQL} AS w FROM benchmark)"


@query(rf"""WITH t AS (SELECT {_PATTERN_SQL})
SELECT doc_id, pattern FROM documents, t WHERE regexp_matches(text, '(^|[^\p{{L}}\p{{N}}_])(?:' || pattern || ')($|[^\p{{L}}\p{{N}}_])', 'i')""")
def pattern_table_hits(spark, sf_dir):
    """Documents by patterns made from each test item's longest word: its ends with letters between, or one letter changed."""
    items = table(spark, sf_dir, "benchmark").select(F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda w: w != "").alias("ws"))
    longest = F.array_sort(F.transform("ws", lambda w: F.struct(-F.length(w), w.alias("w"))))[0]["w"]
    w = F.col("w")
    pattern = F.concat(F.left(w, F.lit(4)), F.lit("[a-z]+"), F.right(w, F.lit(2)), F.lit("|"), F.left(w, F.lit(5)), F.lit("."), F.substr(w, F.lit(7), F.lit(2)))
    listed = items.select(longest.alias("w")).select(pattern.alias("pattern"))
    docs = spread_table(spark, sf_dir, "documents", "doc_id", "text")
    return keywords.match_patterns(docs, "doc_id", "text", listed)


@query("SELECT doc_id FROM documents WHERE contains(coalesce(nullif(lang, 'en'), 'nan'), 'n')")
def stringified_contains(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("l", F.nullif("lang", F.lit("en")))
    return docs.filter(predicates.text_contains(F.col("l"), "n")).select("doc_id")


@query(f"WITH {v.ARTICLES_SQL} SELECT ord, title FROM articles WHERE length(title) >= 5 AND title <> 'No Title'")
def valid_titles(spark, sf_dir):
    return v.articles(spark, sf_dir).filter(predicates.valid_title(F.col("title"))).select("ord", "title")


@query(f"""WITH {v.ARTICLES_SQL} SELECT tool_name, contains(lower(title), lower(tool_name)) AS in_title,
  count(*) AS n FROM articles GROUP BY ALL""")
def mention_prefilter(spark, sf_dir):
    flag = predicates.mentions(F.col("title"), F.col("tool_name"))
    return v.articles(spark, sf_dir).groupBy("tool_name", flag.alias("in_title")).agg(F.count("*").alias("n"))


# --- text functions --------------------------------------------------------------------------


@query(f"""SELECT doc_id, {sql_strip("chr(160) || replace(text, chr(10), chr(9)) || chr(12288) || chr(10)")} AS stripped,
  length(ltrim(chr(9) || text, '{lx.WHITESPACE}'))::INTEGER AS left_length FROM documents""")
def strip_blanks(spark, sf_dir):
    padded = F.concat(F.lit("\xa0"), F.replace("text", F.lit("\n"), F.lit("\t")), F.lit("　\n"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.strip(padded).alias("stripped"),
        F.length(text.lstrip(F.concat(F.lit("\t"), F.col("text")))).alias("left_length"),
    )


@query("""SELECT doc_id, regexp_replace(replace(replace(text, 'e', chr(7)), 'a', chr(31)),
  '[\\x01-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g') AS cleaned FROM documents""")
def control_chars(spark, sf_dir):
    dirty = F.replace(F.replace("text", F.lit("e"), F.lit("\x07")), F.lit("a"), F.lit("\x1f"))
    return table(spark, sf_dir, "documents").select("doc_id", text.remove_control_chars(dirty).alias("cleaned"))


@query("""SELECT doc_id,
  list_aggregate(['Lang', upper(lang[1]) || lang[2:]], 'string_agg', '; ') AS joined,
  '- ' || lang || chr(10) || '- ' || source AS bullets,
  upper(source[1]) || source[2:] AS titled,
  text[1:100] AS truncated,
  'TOOL: ' || source || ' TITLE: "' || text || '" {json}' AS prompt,
  source || '.v1' AS stem
FROM documents""")
def text_shaping(spark, sf_dir):
    lang, source = F.col("lang"), F.col("source")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.join_list(F.array(F.lit("Lang"), text.title_case(lang))).alias("joined"),
        text.bullet_list(F.array(lang, source)).alias("bullets"),
        text.title_case(source).alias("titled"),
        text.truncate(F.col("text"), 100).alias("truncated"),
        text.fill('TOOL: {name} TITLE: "{title}" {json}', name=source, title=F.col("text")).alias("prompt"),
        text.path_stem(F.concat(F.lit("/shots/a.b/"), source, F.lit(".v1.png"))).alias("stem"),
    )


_SEED = "p_brand || ' ' || p_name || '~*'"


@query(f"""SELECT p_partkey, page, (page - 1) * 10 AS first_result,
  '{lx.SEARCH_URL}' || replace(url_encode('"' || {_SEED} || '"'), '%20', '+') || '&first=' || ((page - 1) * 10) AS url,
  'https://list.example.com/?q=1' || CASE WHEN page = 1 THEN '' ELSE '&astart=' || ((page - 1) * 10) END AS listing
FROM part, (SELECT unnest([1, 2, 3]) AS page)""")
def seed_pages(spark, sf_dir):
    seeds = table(spark, sf_dir, "part").select("p_partkey", F.expr(_SEED).alias("name"))
    rows = joins.seed_pages(seeds, 3)
    page = F.col("page")
    return rows.select(
        "p_partkey", "page", urls.page_offset(page).alias("first_result"),
        urls.search_url(F.col("name"), page).alias("url"),
        urls.listing_url(F.lit("https://list.example.com/?q=1"), page - 1).alias("listing"),
    )


# --- result pages ----------------------------------------------------------------------------

# Container and field markup differ by language so that every cascade step is met.
_CARD = {
    "en": ("div class='news-card-body'", "div", "div class='source'", "div class='snippet'"),
    "fr": ("div class='x t_s'", "div", "div class='source-card'", "div class='snippet-card'"),
    "de": ("article class='news-card'", "article", "span class='source'", "p class='snippet'"),
}
_OTHER = ("div data-testid='news-card'", "div", "div data-testid='source'", "div data-testid='snippet'")


def _cards_page(card, title, link, image, source, snippet):
    opening, tag, source_tag, snippet_tag = card
    img = F.when(image.isNotNull(), F.concat(F.lit("<img src='"), image, F.lit("'>"))).otherwise("")
    snip = F.when(
        snippet.isNotNull(),
        F.concat(F.lit(f"<{snippet_tag}>"), v.escaped(snippet), F.lit(f"</{snippet_tag.split()[0]}>")),
    ).otherwise("")
    return F.concat(
        F.lit(f"<{opening}><a class='title' href='"), link, F.lit("'>"), v.escaped(title), F.lit("</a>"),
        img, F.lit(f"<{source_tag}>"), v.escaped(source), F.lit(f"</{source_tag.split()[0]}>"), snip,
        F.lit(f"</{tag}>"),
    )


def _result_pages(spark, sf_dir):
    """One result page per document, one card per line."""
    docs = spread_table(spark, sf_dir, "documents", "doc_id", "lang", "source", "text")
    docs = docs.withColumn("lines", F.split("text", "\n"))
    zipped = F.arrays_zip(F.col("lines").alias("t"), F.slice("lines", 2, F.size("lines")).alias("s"))

    def page(card):
        return F.array_join(
            F.transform(zipped, lambda p, i: _cards_page(
                card, p["t"], F.concat(F.lit("/a/"), F.col("doc_id"), F.lit("#"), i),
                F.when(F.endswith(p["t"], F.lit(".")), F.concat(F.lit("/img/"), F.col("doc_id"))),
                F.col("source"), p["s"],
            )),
            "<hr>",
        )

    body = F.when(F.col("lang") == "en", page(_CARD["en"])).when(F.col("lang") == "fr", page(_CARD["fr"])) \
        .when(F.col("lang") == "de", page(_CARD["de"])).otherwise(page(_OTHER))
    html = F.concat(
        F.lit("<html><head><script>var x='<div class=news-card-body><a>fake title</a></div>';</script></head><body>"),
        body, F.lit("</body></html>"),
    )
    return docs.select("doc_id", "lang", F.col("source").alias("company"), html.alias("html"))


_CARDS_SQL = f"""
WITH {v.ARTICLES_SQL} SELECT doc_id, company, {sql_strip('title')} AS title, link,
  coalesce(image_url, 'No Image') AS image_url, source, coalesce({sql_strip('snippet')}, 'No Snippet') AS snippet
"""


@query(_CARDS_SQL + f"FROM articles WHERE length({sql_strip('title')}) >= 5")
def article_cards(spark, sf_dir):
    rows = news.article_rows(_result_pages(spark, sf_dir))
    return rows.select("doc_id", "company", "title", "link", "image_url", "source", "snippet")


@query(_CARDS_SQL + "FROM articles WHERE lang IN ('en', 'fr')")
def article_cards_basic(spark, sf_dir):
    """The basic spec knows two containers only and keeps rows without a usable title."""
    rows = extract.extract_records(_result_pages(spark, sf_dir), page_specs.ARTICLE_BASIC)
    return rows.select("doc_id", "company", "title", "link", "image_url", "source", "snippet")


@query(f"""WITH {v.ARTICLES_SQL},
cards AS (SELECT ord, tool_name, {sql_strip('title')} AS title, link, coalesce(image_url, 'No Image') AS image_url, source,
  coalesce({sql_strip('snippet')}, 'No Snippet') AS snippet FROM articles WHERE length({sql_strip('title')}) >= 5),
firsts AS (SELECT * FROM cards QUALIFY row_number() OVER (PARTITION BY title ORDER BY ord) = 1),
judged AS (SELECT *, {_classify_sql('title', 'tool_name', v.FUNDING_WORDS, v.FEATURE_WORDS)} AS j FROM firsts WHERE contains(lower(title), tool_name)),
seeds AS (SELECT {v.NAME_SQL} AS tool_name, max(doc_id) AS tool_id FROM documents GROUP BY 1)
SELECT s.tool_id, j.tool_name, 'https://' || s.tool_id || '.example.com' AS tool_url, title, link, image_url, source, snippet,
  length(title)::INTEGER AS title_length, length(snippet)::INTEGER AS snippet_length, image_url <> 'No Image' AS has_image,
  {sql_presence('title', lx.POSITIVE_WORDS)} AS positive_words, {sql_presence('title', lx.NEGATIVE_WORDS)} AS negative_words,
  {sql_presence('title', lx.POSITIVE_WORDS)} - {sql_presence('title', lx.NEGATIVE_WORDS)} AS sentiment_score,
  j.c AS ollama_category, j.r AS company_relevance FROM judged j JOIN seeds s USING (tool_name) WHERE j.r""")
def news_from_pages(spark, sf_dir):
    """End to end: rendered result pages and a seed table with repeated names to output rows."""
    pages = _result_pages(spark, sf_dir).withColumn("tool_name", F.expr(v.NAME_SQL))
    seeds = table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS tool_id", v.NAME_SQL + " AS tool_name", "concat('https://', doc_id, '.example.com') AS tool_url"
    )
    return news.from_pages(pages, seeds, "doc_id", **_WORDS)


@query(f"""WITH {v.ARTICLES_SQL}, n AS (SELECT company, count(*) FILTER (length({sql_strip('title')}) >= 5) AS n
  FROM articles GROUP BY company) SELECT s.company, coalesce(n.n, 0)::BIGINT AS n
FROM (SELECT DISTINCT source AS company FROM documents UNION SELECT n_name FROM nation) s LEFT JOIN n USING (company)""")
def rows_per_seed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("company"))
    seeds = docs.union(table(spark, sf_dir, "nation").select("n_name")).distinct()
    return aggregates.rows_per_seed(seeds, news.article_rows(_result_pages(spark, sf_dir)).select("company"), "company")


@query("""WITH n AS (SELECT user_id, day(ts)::INTEGER AS page, count(*) FILTER (event_type = 'view') AS n_items
  FROM events GROUP BY ALL),
s AS (SELECT user_id, min(page) AS stop FROM n WHERE n_items = 0 GROUP BY user_id)
SELECT n.user_id, n.page, n.n_items FROM n LEFT JOIN s USING (user_id) WHERE s.stop IS NULL OR n.page < s.stop""")
def early_stop(spark, sf_dir):
    pages = table(spark, sf_dir, "events").groupBy("user_id", F.dayofmonth("ts").alias("page")).agg(
        F.count_if(F.col("event_type") == "view").alias("n_items")
    )
    return ordinals.early_stop(pages, "user_id", "page", "n_items", spread_by=["page"])


# --- model-backed ----------------------------------------------------------------------------


def _stand_in(prompts):
    """Answers as a model would, by counting letters: valid, broken, wrong label, or prose."""
    out = []
    for p in prompts:
        title = p.split('Headline: "', 1)[1].rsplit('"\n\nJudge', 1)[0]
        n = title.count("e")
        if n < 3:
            out.append(json.dumps({"category": "funding", "company_relevance": True, "reasoning": "few"}))
        elif n < 6:
            out.append('{"category": "funding", "company_relevance"')
        elif n < 9:
            out.append(json.dumps({"category": "weather", "company_relevance": True, "reasoning": "x"}))
        else:
            out.append(json.dumps({"category": "news article", "company_relevance": "no", "reasoning": "many"}))
    return out


@query(f"""
WITH {v.ARTICLES_SQL},
named AS (SELECT *, length(title) - length(replace(title, 'e', '')) AS n_e,
  {_classify_sql('title', 'tool_name', v.FUNDING_WORDS, v.FEATURE_WORDS)} AS j
  FROM articles WHERE contains(lower(title), lower(tool_name))),
judged AS (SELECT ord, CASE WHEN j.w = 'Title too short' THEN j.c WHEN n_e < 3 THEN 'funding'
    WHEN n_e >= 9 THEN 'news article' ELSE j.c END AS category,
  CASE WHEN j.w = 'Title too short' THEN false WHEN n_e < 3 THEN true WHEN n_e >= 9 THEN false ELSE j.r END AS company_relevance
  FROM named)
SELECT * FROM judged WHERE company_relevance""")
def enrich_titles(spark, sf_dir):
    rows = v.articles(spark, sf_dir).select("ord", "title", "tool_name")
    judged = news.classify(rows, infer=_stand_in, spread_by=["ord"], **_WORDS)
    return judged.select("ord", "category", "company_relevance")


def _free_text(prompts):
    titles = [p.split('Headline: "', 1)[1].rsplit('"\nWhich', 1)[0] for p in prompts]
    answers = {0: "Funding.", 1: " Update ", 2: "It announces a launch", 3: "no idea"}
    return [answers[t.count("e") % 4] for t in titles]


@query(f"""WITH {v.ARTICLES_SQL} SELECT ord, CASE WHEN length({sql_strip('title')}) < 10 THEN 'news article' ELSE
  CASE (length(title) - length(replace(title, 'e', ''))) % 4 WHEN 0 THEN 'funding' WHEN 3 THEN 'news article' ELSE 'feature update' END END AS category
FROM articles""")
def label_titles(spark, sf_dir):
    """Free-text answers mapped to three categories."""
    rows = v.articles(spark, sf_dir).select("ord", "title")
    return news.label_titles(rows, _free_text, spread_by=["ord"]).select("ord", "category")


def _translate(prompts):
    prefix = lx.TRANSLATE_PROMPT.removesuffix("{text}")
    texts = [p[len(prefix):] for p in prompts]
    return [
        None if len(t) < 500 else json.dumps({"response": "  \n" + t.upper(), "total_duration": len(t)})
        for t in texts
    ]


@query("""SELECT text AS original, count(*) AS n, any_value(length(text)) AS duration FROM documents
WHERE lang = 'fr' AND length(text) >= 500 GROUP BY text""")
def enrich_translation(spark, sf_dir):
    french = table(spark, sf_dir, "documents").filter("lang = 'fr'")
    rows = enrich.translate(french, "text", _translate)
    return rows.groupBy("original").agg(F.count("*").alias("n"), F.max("duration").alias("duration"))
