"""Table layouts. Every column is nullable; partition columns are named per table."""

from __future__ import annotations

SENTIMENT = "struct<label:string,score:double>"
SHARES = "array<struct<label:string,percentage:double>>"
SOURCES = "array<struct<domain:string,count:bigint>>"

ARTICLES = (
    "article_id long, title string, url string, text string, summary string, source string, "
    "scraped_at timestamp, published_at timestamp, category string, batch int, topic string, "
    f"sentiment {SENTIMENT}, isCleaned boolean, status string, created_at timestamp, sample string"
)

CLEAN_ARTICLES = (
    "article_id long, title string, url string, source string, source_domain string, "
    f"scraped_at timestamp, published_at timestamp, category string, batch int, topic string, sentiment {SENTIMENT}, "
    "nouns array<string>, summary string, embedding array<float>, isProcessed boolean, "
    "isEmbedded boolean, isCleaned boolean, created_at timestamp, sample string"
)

LINK_POOL = "url string, is_articles_processed boolean, in_sample string, created_at timestamp"

#: One row per change of a link; the pool is what the rows of each url add up to.
LINK_MARKS = LINK_POOL + ", marked_at timestamp, bucket int"

#: One row per change of a flag of a stored row, kept beside the texts.
FLAG_LOG = "article_id long, value boolean, at timestamp, sample string"

TERM_WEIGHTS = "slot int, idf double, n long"

METADATA = (
    "sample string, batch int, prev string, next string, "
    "articles_processed struct<successfully:bigint,unsuccessfully:bigint,skipped:bigint>, "
    f"topic_distribution {SHARES}, sentiment_distribution {SHARES}, "
    "raw_total_words bigint, distinct_words bigint, "
    "gathering_started_at timestamp, gathering_finished_at timestamp, "
    "cleaning_started_at timestamp, cleaning_finished_at timestamp, "
    "analyze_started_at timestamp, analyze_finished_at timestamp"
)

THREADS = (
    "sample string, thread_id string, cluster_id string, size bigint, centroid array<double>, "
    "topic_label string, top_terms array<string>, top_entities array<string>, "
    f"sources {SOURCES}, representative_titles array<string>, sum_article_weight double, "
    "diversity_bonus double, cluster_score_today double, ema double, novelty double, "
    "trend_score double, created_at timestamp, date date"
)

# Landed feed payloads.
FEED_PAGE = (
    "category string, articles array<struct<"
    "title:string,url:string,content:string,publishedAt:string,source:struct<name:string>>>"
)
RSS_ITEM = "title string, link string, description string, pubDate string"
