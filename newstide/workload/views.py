"""The domain tables, derived from the given parquet tables.

Each view covers its whole source table and takes its values from the rows, so
that copies, labels and lengths of the data show up as duplicates, flags and ages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newstide.config import CATEGORY_WEIGHTS, SOURCE_WEIGHTS, TOPICS, ScoringConfig
from newstide.functions.samples import sample_batch, sample_date
from newstide.functions.text import blank_to_null, strip, terms, words
from newstide.functions.urls import source_domain
from newstide.operators.ordinals import ordinal_within
from newstide.session import broadcast_if_small, cut, spread

AS_OF = "2025-08-15 00:00:00"
TEXT_KEYS = {"documents": "doc_id", "pages": "page_id"}

# The weights of the reputable domains, keyed by the hosts the derived urls have.
TEST_SOURCE_WEIGHTS = dict(
    zip(
        ["src0.example.com", "src5.example.com", "src10.example.com", "src1.example.com", "unknown"],
        SOURCE_WEIGHTS.values(),
    )
)
TEST_SCORING = ScoringConfig(source_weights=TEST_SOURCE_WEIGHTS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, TEXT_KEYS[name]) if name in TEXT_KEYS else df


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def _pick(values: list[str], index) -> F.Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    doc = F.col("doc_id")
    size = F.col("n_chars")
    host = F.concat(F.lit("https://www.src"), (size % 20).cast("string"), F.lit(".example.com/"))
    start = F.lit("2025-08-10 00:00:00").cast("timestamp_ntz")
    scraped = start + F.make_dt_interval(hours=(doc % 120).cast("int"))
    day = F.concat(F.lit("2025-08-1"), (doc % 5).cast("string"))
    return docs.join(labels, "doc_id", "left").select(
        doc.alias("article_id"),
        F.when(F.col("lang") != "es", blank_to_null(F.get(F.split("text", "\n"), 0))).alias("title"),
        F.concat(host, F.md5(F.col("text"))).alias("url"),
        "text",
        "lang",
        "source",
        scraped.alias("scraped_at"),
        F.when(F.col("lang") != "de", scraped - F.make_dt_interval(hours=(size % 48).cast("int"))).alias("published_at"),
        (scraped + F.make_dt_interval(mins=(doc % 60).cast("int"))).alias("created_at"),
        _pick(list(CATEGORY_WEIGHTS), size % 9).alias("category"),
        (doc % 2 + 1).cast("int").alias("batch"),
        F.coalesce(_pick(TOPICS, size % 13), F.lit("unknown")).alias("topic"),
        F.struct(
            F.when(F.col("toxic") == 1, "NEGATIVE").when(F.col("toxic") == 0, "POSITIVE").otherwise("unknown").alias("label"),
            ((F.coalesce("quality", F.lit(0)) + 1) / 2.0).alias("score"),
        ).alias("sentiment"),
        (F.col("quality") == 1).alias("isCleaned"),
        (F.col("quality") == 1).alias("isProcessed"),
        F.concat((doc % 2 + 1).cast("string"), F.lit("-"), day).alias("sample"),
    )


def clean_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with text, their terms and domain; the summary is the whole text."""
    return (
        articles(spark, sf_dir)
        .where(strip(F.col("text")) != "")
        .withColumn("nouns", terms(F.col("text")))
        .withColumn("summary", strip(F.col("text")))
        .withColumn("source_domain", source_domain(F.col("url")))
    )


def link_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per url of a labelled article; good ones were processed, toxic ones only sampled."""
    rows = articles(spark, sf_dir).where(F.col("sentiment.label") != "unknown")
    return rows.groupBy("url").agg(
        F.max("isProcessed").alias("is_articles_processed"),
        F.max(F.when(F.col("sentiment.label") == "NEGATIVE", F.col("sample"))).alias("in_sample"),
        F.min("scraped_at").alias("created_at"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sample of the articles, and one with an unreadable id per source."""
    rows = articles(spark, sf_dir)
    good = rows.select("sample").distinct()
    bad = rows.select(F.concat_ws("-", "source", F.lit("2025-08-10")).alias("sample")).distinct()
    ids = good.unionByName(bad)
    return ids.select("sample", sample_batch(F.col("sample")).alias("batch"), sample_date(F.col("sample")).alias("date"))


def grouped_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean articles with a given grouping: one cluster per sample and language.

    Cluster ids number the clusters of a sample by their first member.
    """
    rows = clean_articles(spark, sf_dir)
    firsts = rows.groupBy("sample", "lang").agg(F.min("article_id").alias("first"))
    numbered = ordinal_within(firsts, "sample", "first").select(
        "sample", "lang", F.concat_ws("-", "sample", F.col("ordinal").cast("string")).alias("cluster_id")
    )
    return rows.join(broadcast_if_small(numbered), ["sample", "lang"])


def cluster_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_articles(spark, sf_dir).select(
        "cluster_id", "article_id", "title", "text", "nouns", "topic", F.col("source_domain").alias("domain")
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.lit("all").alias("grp"), F.col("vec_id").alias("id"), F.col("embedding").alias("vec")
    )


def topic_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A (word, topic, weight) lexicon: the words of the benchmark items, a topic per item."""
    items = table(spark, sf_dir, "benchmark")
    topic = _pick(TOPICS, F.col("item_id") % 12)
    rows = items.select(F.explode(words(F.col("text"))).alias("word"), topic.alias("topic"))
    return rows.distinct().withColumn("weight", F.lit(1.0))


def polarity_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A (word, polarity) lexicon: +1 for words users write more often than others, else -1."""
    turns = table(spark, sf_dir, "conversations")
    rows = turns.select(F.explode(words(F.col("text"))).alias("word"), F.when(F.col("role") == "user", 1).otherwise(-1).alias("p"))
    return rows.groupBy("word").agg(F.when(F.sum("p") > 0, 1.0).otherwise(-1.0).alias("polarity"))


def thread_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (user segment, day): score and entities of a thread, from the events."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("date"), F.concat_ws("/", "event_type", F.get_json_object("props", "$.k")).alias("thread_id"))
        .agg(
            (F.count("*") / 10.0).alias("cluster_score_today"),
            F.array_sort(F.collect_set(F.concat(F.lit("u"), F.col("user_id").cast("string")))).alias("top_entities"),
        )
    )


def raw_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three intake sources as one: the articles, the landed pages and the conversation turns."""
    from newstide.sources.pages import article_text, page_title
    from newstide.sources.union import union_sources

    feed = articles(spark, sf_dir).select(
        F.col("article_id").alias("ord"), "title", F.when(F.col("source") != "src19", F.col("url")).alias("url"), "text", "source", "sample", "scraped_at"
    )
    # Extracted once: the filters that follow would work the text out again.
    pages = cut(table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("ord"), page_title(F.col("html")).alias("title"), "url", article_text(F.col("html")).alias("text"), F.lit("pages").alias("source")
    ))
    turns = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"),
        F.col("role").alias("title"),
        F.concat(F.lit("https://chat.example.com/"), F.col("conv_id").cast("string")).alias("url"),
        "text",
        F.lit("chat").alias("source"),
    )
    return union_sources([feed, pages, turns], "ord").drop("ord")


def sample_like_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts shaped like sample ids, one per document, many of them with impossible dates."""
    n = F.col("n_chars")
    parts = [n % 7, n % 90 + 2015, F.lpad((n % 14).cast("string"), 2, "0"), F.lpad((n % 33).cast("string"), 2, "0")]
    return table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("-", *[p.cast("string") for p in parts]).alias("sample"))


def dates_of_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of the articles' creation times, which include days without samples."""
    return articles(spark, sf_dir).select(F.to_date("published_at").alias("date")).where("date is not null").distinct()
