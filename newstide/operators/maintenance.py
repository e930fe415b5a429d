"""Pruning of stale rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.operators.filters import not_yet
from newstide.session import side_by_side


def cutoff(as_of: Column, days: int = 7) -> Column:
    return as_of - F.make_dt_interval(days=F.lit(days))


def stale_link(limit: Column) -> Column:
    """Never given to a sample, never processed, and old."""
    return F.coalesce(F.col("in_sample").isNull() & not_yet(F.col("is_articles_processed")) & (F.col("created_at") < limit), F.lit(False))


def stale_article(limit: Column) -> Column:
    """Without text, and old."""
    return F.coalesce((F.col("text").isNull() | (F.col("text") == "")) & (F.col("scraped_at") < limit), F.lit(False))


def stale_clean(limit: Column) -> Column:
    """Processed, and old."""
    return F.coalesce((F.col("isProcessed") == F.lit(True)) & (F.col("scraped_at") < limit), F.lit(False))


RULES = {"link_pool": stale_link, "articles": stale_article, "clean_articles": stale_clean}


def keep_fresh(df: DataFrame, table: str, as_of: Column, days: int = 7) -> DataFrame:
    """The rows of one of the three tables that pruning leaves."""
    return df.where(~RULES[table](cutoff(as_of, days)))


def prune_counts(pool: DataFrame, articles: DataFrame, clean: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """What pruning deletes: one row with three counts and the cutoff."""
    limit = cutoff(as_of, days)

    def n(df: DataFrame, table: str, name: str) -> DataFrame:
        return df.agg(F.count_if(RULES[table](limit)).alias(name))

    counts = side_by_side(
        n(pool, "link_pool", "link_pool_deleted"),
        n(articles, "articles", "articles_deleted"),
        n(clean, "clean_articles", "clean_deleted"),
    )
    return counts.withColumn("cutoff", F.date_format(limit, "yyyy-MM-dd HH:mm:ss"))
