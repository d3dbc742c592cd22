"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from gleanwork import workload

HEADLINE = (
    "news_by_category", "news_rows", "news_summary", "article_features", "title_dedup_exact",
    "answer_normalizer", "keyword_filter_word", "keyword_table_hits", "article_cards",
    "news_from_pages", "enrich_titles",
    "catalog_merge_nullsafe", "tag_upsert", "one_per_tool", "dup_explain", "keep_first",
    "two_pass_verdict", "response_validate", "frontier", "batch_ids", "shards",
    "merge_generations", "page_fields", "page_links", "review_rows", "affiliation_stats",
    "stream_status_counts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gleanwork-bench-"))
    queries = workload.queries()
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    small = small if os.path.isdir(small) else sf_dir
    seconds = {}
    for name in HEADLINE:
        queries[name](spark, small).collect()  # warm-up, not timed
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
