"""Clean: articles to terms, summary, vector and domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.functions.text import strip
from newstide.functions.urls import source_domain
from newstide.operators.models import Models, choose_summary, embed_text, embed_with, extract_terms, fit_idf
from newstide.session import cut
from newstide.sources.tables import Tables

COLUMNS = (
    "article_id title url source source_domain scraped_at published_at category batch sample topic sentiment nouns "
    "summary embedding isProcessed isEmbedded isCleaned created_at"
).split()


def clean(articles: DataFrame, idf: DataFrame | None = None, lexicon: DataFrame | None = None, models: Models = Models()) -> DataFrame:
    """Clean rows of the articles that have text. ``idf`` is the stored weight table of the default vectors."""
    rows = cut(choose_summary(articles.where(strip(F.col("text")) != ""), models))  # read twice, summarised once
    vectors = embed_with(rows, models) if models.embedder else embed_text(rows, idf)
    out = (
        extract_terms(rows, lexicon, models=models)
        .join(vectors.withColumnRenamed("vec", "embedding"), "article_id", "left")
        .withColumn("source_domain", source_domain(F.col("url")))
        .withColumn("isProcessed", F.lit(False))
        .withColumn("isEmbedded", F.col("embedding").isNotNull())
        .withColumn("isCleaned", F.lit(True))
    )
    return out.select(*COLUMNS)


def stamp(tables: Tables, sample: str, **values: Column) -> None:
    """Set columns of the sample's metadata row."""
    meta = tables.read("metadata")
    for name, value in values.items():
        meta = meta.withColumn(name, F.when(F.col("sample") == sample, value.cast(meta.schema[name].dataType)).otherwise(F.col(name)))
    tables.rewrite("metadata", meta)


def term_weights(tables: Tables, rows: DataFrame) -> DataFrame:
    """The stored weight table of the default vectors; the first call fits it on ``rows`` and stores it for all days to come."""
    stored = tables.read("term_weights")
    if not stored.limit(1).count():
        text = None if "text" in rows.columns else F.col("summary")
        tables.append("term_weights", fit_idf(rows, text), ["slot"])
        stored = tables.read("term_weights")
    return stored


def run_clean(tables: Tables, sample: str, as_of: Column, idf: DataFrame | None = None, models: Models = Models()) -> None:
    """Clean one sample of the stored articles and mark the articles cleaned; a second run replaces the rows of the first.

    Marks go to a log beside the articles, so no text is written again. Without ``idf`` the stored weight table is used.
    """
    articles = tables.read("articles").where(F.col("sample") == sample)
    if idf is None and not models.embedder:
        idf = term_weights(tables, articles)
    tables.upsert("clean_articles", clean(articles, idf, models=models), ["sample", "url"])
    done = tables.read("clean_articles").where(F.col("sample") == sample)
    tables.set_flag("articles", articles.select("sample", "article_id").join(done.select("article_id"), "article_id", "left_semi"))
    stamp(tables, sample, cleaning_started_at=as_of, cleaning_finished_at=as_of)
