"""Landed feed payloads: JSON result pages and RSS files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newstide import schemas
from newstide.functions.text import blank_to_null, coerce_variant, strip
from newstide.operators.filters import has_unwanted, publication_status


def read_feed_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One row per feed article. Result pages may be partitioned by category.

    Pages are landed one per line, which Spark can split; ``multi_line`` reads one page per file.
    """
    pages = spark.read.schema(schemas.FEED_PAGE).option("multiLine", multi_line).json(path)
    return pages.select("category", F.explode("articles").alias("a")).select("category", "a.*")


def read_feed_variant(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_feed_json`` for pages, one per line, whose fields change type from entry to entry.

    Titles and contents may be text, numbers, lists or objects, and a source its name alone; a typed reader would make
    such entries null. Lines that are no JSON, and pages without a list of articles, give no rows. A field that is
    missing or null stays null.
    """
    lines = spark.read.text(path)
    page = lines.withColumn("page", F.try_parse_json("value"))
    category = F.col("category").cast("string") if "category" in lines.columns else F.try_variant_get("page", "$.category", "string")
    rows = page.select(category.alias("category"), F.explode(F.try_variant_get("page", "$.articles", "array<variant>")).alias("a"))

    def text(name: str) -> Column:
        value = F.try_variant_get("a", f"$.{name}", "variant")
        return F.when(value.isNotNull() & ~F.is_variant_null(value), coerce_variant(value)).alias(name)

    named = F.try_variant_get("a", "$.source.name", "string")
    alone = F.when(F.schema_of_variant(F.try_variant_get("a", "$.source", "variant")) == "STRING", F.try_variant_get("a", "$.source", "string"))
    return rows.select(
        "category", text("title"), F.try_variant_get("a", "$.url", "string").alias("url"), text("content"),
        F.try_variant_get("a", "$.publishedAt", "string").alias("publishedAt"), F.struct(F.coalesce(named, alone).alias("name")).alias("source"),
    )


def _entries(feed: DataFrame, scraped_at: Column) -> DataFrame:
    return feed.where(~has_unwanted(F.col("content")) & (F.coalesce("url", F.lit("")) != "")).select(
        "url",
        F.coalesce(strip(F.col("title")), F.lit("")).alias("title"),
        F.coalesce("source.name", F.lit("")).alias("source"),
        scraped_at.alias("scraped_at"),
        F.col("publishedAt").alias("published_at"),
        "category",
    )


def topical_feed(feed: DataFrame, bodies: DataFrame, scraped_at: Column) -> DataFrame:
    """Wanted entries with a landed body. ``bodies`` has one (url, text) per url."""
    rows = _entries(feed, scraped_at).drop("published_at", "category")
    return rows.join(bodies, "url").where(blank_to_null(F.col("text")).isNotNull()).withColumn("text", strip(F.col("text")))


def category_feed(feed: DataFrame, bodies: DataFrame, scraped_at: Column, target: Column) -> DataFrame:
    """As the topical feed, with category and publication time, for one publication date."""
    on_day = feed.where(publication_status(F.col("publishedAt"), target) == "kept")
    rows = _entries(on_day, scraped_at).join(bodies, "url")
    return rows.where(blank_to_null(F.col("text")).isNotNull()).withColumn("text", strip(F.col("text")))


def category_feed_counts(feed: DataFrame, target: Column) -> DataFrame:
    """Entries on the target date and on other dates; unreadable dates count as neither."""
    status = publication_status(F.col("publishedAt"), target)
    return feed.agg(F.count_if(status == "kept").alias("on_date"), F.count_if(status == "skipped").alias("skipped"))


def read_rss(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", "item").schema(schemas.RSS_ITEM).load(path)


def rss_with_summaries(items: DataFrame, source: str, scraped_at: Column) -> DataFrame:
    """Entries that have a link, a title and a summary; the summary is the text."""
    rows = items.select(
        F.col("link").alias("url"),
        strip(F.col("title")).alias("title"),
        strip(F.col("description")).alias("text"),
        F.lit(source).alias("source"),
        scraped_at.alias("scraped_at"),
    )
    return rows.where((F.col("url") != "") & (F.col("title") != "") & (F.col("text") != ""))


def rss_with_bodies(items: DataFrame, bodies: DataFrame, source: str, scraped_at: Column) -> DataFrame:
    """Entries that have a link and a title and whose page body has landed."""
    rows = items.select(
        F.col("link").alias("url"), strip(F.col("title")).alias("title"), F.lit(source).alias("source"), scraped_at.alias("scraped_at")
    )
    return rows.where((F.col("url") != "") & (F.col("title") != "")).join(bodies, "url").where(F.col("text") != "")
