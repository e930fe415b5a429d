"""Counts and shares per sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newstide.operators.filters import not_yet
from newstide.session import side_by_side


def sample_distributions(done: DataFrame) -> DataFrame:
    """Topic and sentiment shares of the successful articles of each sample, two decimals."""
    labels = F.explode(
        F.array(
            F.struct(F.lit("topic").alias("kind"), F.col("topic").alias("label")),
            F.struct(F.lit("sentiment").alias("kind"), F.coalesce("sentiment.label", F.lit("unknown")).alias("label")),
        )
    )
    total = F.sum("n").over(Window.partitionBy("sample", "kind"))
    return (
        done.select("sample", labels.alias("x"))
        .groupBy("sample", "x.kind", "x.label")
        .agg(F.count("*").alias("n"))
        .withColumn("percentage", F.bround(F.col("n") / total * 100, 2))
    )


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """Articles per sample by status ok, failed or skipped."""
    by = F.col("status")
    return outcomes.groupBy("sample").agg(
        F.count_if(by == "ok").alias("successfully"),
        F.count_if(by == "failed").alias("unsuccessfully"),
        F.count_if(by == "skipped").alias("skipped"),
    )


def per_sample_counts(samples: DataFrame, articles: DataFrame, clean: DataFrame) -> DataFrame:
    """Raw and clean article counts of the given samples, 0 where there are none."""
    raw_n = articles.groupBy("sample").agg(F.count("*").alias("articles"))
    clean_n = clean.groupBy("sample").agg(F.count("*").alias("clean_articles"))
    return (
        samples.select("sample")
        .join(raw_n, "sample", "left")
        .join(clean_n, "sample", "left")
        .select("sample", F.coalesce("articles", F.lit(0)).alias("articles"), F.coalesce("clean_articles", F.lit(0)).alias("clean_articles"))
    )


def backlog_counts(articles: DataFrame, clean: DataFrame) -> DataFrame:
    """Articles still to clean and clean articles still to mark processed."""
    return side_by_side(
        articles.agg(F.count_if(not_yet(F.col("isCleaned"))).alias("to_clean")),
        clean.agg(F.count_if(not_yet(F.col("isProcessed"))).alias("to_mark_processed")),
    )


def top_sources(articles: DataFrame, limit: int = 10) -> DataFrame:
    return (
        articles.groupBy("source")
        .agg(F.count("*").alias("cnt"))
        .orderBy(F.desc("cnt"), F.asc_nulls_last("source"))
        .limit(limit)
    )
