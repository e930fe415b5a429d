"""Word trends: occurrences, counts, metrics and the ranked words with their context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newstide.config import INVALID_SENTIMENTS, INVALID_TOPICS
from newstide.functions.text import explode_words, strip


def valid_topic(topic: Column) -> Column:
    low = F.lower(strip(topic))
    return F.when(~low.isin(INVALID_TOPICS), low)


def valid_sentiment(label: Column) -> Column:
    low = F.lower(strip(label))
    return F.when(~low.isin(INVALID_SENTIMENTS), low)


def word_occurrences(clean: DataFrame) -> DataFrame:
    """One row per noun of each article, with its valid topic and sentiment or null."""
    labelled = clean.select(  # before the explode, so that labels are checked once per article
        "sample",
        valid_topic(F.col("topic")).alias("topic"),
        valid_sentiment(F.col("sentiment.label")).alias("sentiment"),
        "nouns",
    )
    return explode_words(labelled, F.col("nouns"), "sample", "topic", "sentiment")


def word_profile(clean: DataFrame) -> DataFrame:
    """Counts by (sample, word, topic, sentiment): the one shuffle all word reports start from."""
    return word_occurrences(clean).groupBy("sample", "word", "topic", "sentiment").agg(F.count("*").alias("cnt"))


def word_counts(clean: DataFrame) -> DataFrame:
    return word_occurrences(clean).groupBy("sample", "word").agg(F.count("*").alias("cnt"))


def word_metrics(clean: DataFrame) -> DataFrame:
    """Total and distinct words per sample, from the word counts so that no set is built."""
    return (
        word_counts(clean)
        .groupBy("sample")
        .agg(F.sum("cnt").alias("total_words"), F.count("*").alias("distinct_words"))
    )


def rank_words(counts: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` most frequent words of each sample; equal counts rank by word.

    The rank filter lets Spark keep only ``limit`` rows per sample and task before
    the shuffle, so a sample's vocabulary never meets in one task.
    """
    order = Window.partitionBy("sample").orderBy(F.desc("cnt"), F.asc("word"))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def _both_kinds(topic: Column, sentiment: Column, n: Column) -> Column:
    """A count under its topic and under its sentiment, as an array of (kind, label, n)."""
    return F.array(
        F.struct(F.lit("topic").alias("kind"), topic.alias("label"), n.alias("n")),
        F.struct(F.lit("sentiment").alias("kind"), sentiment.alias("label"), n.alias("n")),
    )


def _percentage(*group: str) -> Column:
    """Half-even whole percent of ``n`` among the rows of the group that have a label."""
    total = F.sum(F.when(F.col("label").isNotNull(), F.col("n"))).over(Window.partitionBy(*group))
    return F.bround(F.col("n") / total * 100, 0).cast("int")


def word_context(profile: DataFrame) -> DataFrame:
    """Topic and sentiment shares of each word over its valid labels, in whole percent.

    The counts of a word, one per pair of labels, are brought together once; what follows needs no further shuffle.
    """
    both = F.explode(_both_kinds(F.col("topic"), F.col("sentiment"), F.col("cnt")))
    return (
        profile.repartition("sample", "word").select("sample", "word", both.alias("x"))
        .where("x.label is not null")
        .groupBy("sample", "word", "x.kind", "x.label")
        .agg(F.sum("x.n").alias("n"))
        .withColumn("percentage", _percentage("sample", "word", "kind"))
    )


def daily_words(clean: DataFrame, limit: int = 15) -> DataFrame:
    """Ranked words, one row per label; a word without any valid label has kind 'none'.

    One pass: the counts by (topic, sentiment) ride along with each word as a list,
    at most one entry per pair of labels, and only the lists of the top words are opened.
    """
    pairs = F.collect_list(F.struct("topic", "sentiment", "cnt")).alias("pairs")
    per_word = word_profile(clean).groupBy("sample", "word").agg(F.sum("cnt").alias("cnt"), pairs)
    opened = F.flatten(F.transform("pairs", lambda p: _both_kinds(p["topic"], p["sentiment"], p["cnt"])))
    labelled = F.count("label").over(Window.partitionBy("sample", "word"))
    rows = (
        rank_words(per_word, limit)
        .select("sample", "rank", "word", "cnt", F.explode(opened).alias("x"))
        .groupBy("sample", "rank", "word", "cnt", "x.kind", "x.label")
        .agg(F.sum("x.n").alias("n"))
        .withColumn("percentage", _percentage("sample", "word", "kind"))
        .withColumn("_labelled", labelled)
    )
    missing = (F.col("_labelled") == 0) & (F.col("kind") == "topic")
    return rows.where(F.col("label").isNotNull() | missing).select(
        "sample",
        "rank",
        "word",
        "cnt",
        F.when(F.col("label").isNull(), "none").otherwise(F.col("kind")).alias("kind"),
        "label",
        F.when(F.col("label").isNotNull(), F.col("n")).alias("n"),
        "percentage",
    ).withColumn("percentage", F.when(F.col("label").isNotNull(), F.col("percentage")))


def daily_words_nested(clean: DataFrame, limit: int = 15) -> DataFrame:
    """The stored form: one row per word with its two share lists, largest share first."""
    flat = daily_words(clean, limit)

    def shares(kind: str) -> Column:
        rows = F.collect_list(F.when(F.col("kind") == kind, F.struct((-F.col("n")).alias("o"), "label", "percentage")))
        return F.transform(F.sort_array(rows), lambda r: F.struct(r["label"].alias("label"), r["percentage"].alias("percentage")))

    return flat.groupBy("sample", "rank", "word", "cnt").agg(
        shares("topic").alias("topics"), shares("sentiment").alias("sentiments")
    )
