"""Table schemas as Spark DDL. Readers pass these instead of inferring."""

TOOL_SEED = "tool_id BIGINT, tool_name STRING, tool_url STRING"
REVIEW = (
    "tool_name STRING, review_id STRING, review_text STRING, review_date STRING, "
    "user_name STRING, user_href STRING, helpful_count STRING, all_time_score STRING, "
    "amount_of_reviews STRING, tool_link STRING, recent_review_score STRING, "
    "recent_reviews_amount STRING, product_url STRING"
)
SCIENTIST = (
    "name STRING, profile_url STRING, affiliation STRING, email STRING, citations STRING, "
    "interests STRING, profile_picture_url STRING, profile_picture_alt STRING, label STRING, "
    "tab_index INT, page_number INT, scraped_at STRING"
)
CRAWL_LEDGER = "url STRING, status STRING, run_id STRING, ts TIMESTAMP"
