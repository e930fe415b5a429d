"""The pool of links already seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_processed() -> Column:
    """A link counts as done when it is flagged or has been given to a sample."""
    flagged = F.coalesce(F.col("is_articles_processed"), F.lit(False))
    return flagged | (F.coalesce(F.col("in_sample"), F.lit("")) != "")


BUCKETS = 64


def bucket_of(url: Column) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(BUCKETS)).cast("int")


def as_marks(rows: DataFrame, at: Column | None = None) -> DataFrame:
    """Rows of the change log from pool rows, or from (url, sample, created_at), which mark a url as done for a sample."""
    if "sample" in rows.columns:
        rows = rows.select("url", F.lit(True).alias("is_articles_processed"), F.col("sample").alias("in_sample"), "created_at")
    marked = F.col("created_at") if at is None else at
    return rows.select("url", "is_articles_processed", "in_sample", "created_at", marked.cast("timestamp").alias("marked_at"), bucket_of(F.col("url")).alias("bucket"))


def latest(marks: DataFrame) -> DataFrame:
    """The pool: per url its last mark that says anything, and when it was first seen.

    Marks of one time are ordered by sample. A url that was only tracked has neither flag nor sample.
    """
    says = F.col("is_articles_processed").isNotNull() | F.col("in_sample").isNotNull()
    last = F.max(F.when(says, F.struct("marked_at", "in_sample", "is_articles_processed")))
    rows = marks.groupBy("url").agg(last.alias("last"), F.min("created_at").alias("created_at"))
    return rows.select("url", "last.is_articles_processed", "last.in_sample", "created_at")


def gate(articles: DataFrame, pool: DataFrame) -> DataFrame:
    """The articles whose url was not processed before."""
    return articles.join(pool.where(is_processed()).select("url"), "url", "left_anti")


def ensure_tracked(pool: DataFrame, urls: DataFrame) -> DataFrame:
    """Add unknown urls; rows of known ones stay as they are. ``urls`` has (url, created_at)."""
    new = urls.groupBy("url").agg(F.min("created_at").alias("created_at")).join(pool, "url", "left_anti")
    return pool.unionByName(
        new.select(
            "url",
            F.lit(None).cast("boolean").alias("is_articles_processed"),
            F.lit(None).cast("string").alias("in_sample"),
            "created_at",
        )
    )


def mark_processed(pool: DataFrame, urls: DataFrame) -> DataFrame:
    """Flag urls as processed for a sample, adding unknown ones. ``urls`` has (url, sample, created_at)."""
    done = urls.groupBy("url").agg(F.max_by("sample", F.struct("created_at", "sample")).alias("sample"),
                                   F.min("created_at").alias("first_seen"))
    joined = pool.join(done, "url", "full_outer")
    hit = F.col("sample").isNotNull()
    return joined.select(
        "url",
        F.when(hit, F.lit(True)).otherwise(F.col("is_articles_processed")).alias("is_articles_processed"),
        F.when(hit, F.col("sample")).otherwise(F.col("in_sample")).alias("in_sample"),
        F.coalesce("created_at", "first_seen").alias("created_at"),
    )
