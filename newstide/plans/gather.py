"""Gather: sources to classified articles, summaries, link pool and sample metadata."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.config import TOPICS
from newstide.functions.samples import sample_batch, sample_date
from newstide.operators import links
from newstide.operators.dedup import dedup_in_run
from newstide.operators.filters import candidates
from newstide.operators.models import Models, classify, topic_lexicon
from newstide.operators.ordinals import ordinal_within
from newstide.operators.samples import date_spine
from newstide.operators.stats import outcome_counts, sample_distributions
from newstide.session import cut, side_by_side
from newstide.sources.tables import Tables


@dataclass(frozen=True)
class Gathered:
    articles: DataFrame
    summaries: DataFrame
    link_pool: DataFrame
    metadata: DataFrame
    marks: DataFrame


def admit(rows: DataFrame, pool: DataFrame, order: tuple[str, ...] = ("source_ord", "pos")) -> DataFrame:
    """Mark each candidate 'new' or 'skipped'.

    Skipped are later copies of a url of this run and urls processed before. The
    winner of each url is found by a per-task reduction; the pool, which has one
    row per url, then joins one winner per url, and the remaining rows are
    matched on (url, order), so no url is ever gathered in one task.
    """
    first = dedup_in_run(rows.select("url", *order), order)
    done = pool.where(links.is_processed()).select("url")
    new = first.join(done, "url", "left_anti").withColumn("_new", F.lit(True))
    marked = rows.join(new, ["url", *order], "left")
    return marked.withColumn("status", F.when(F.col("_new"), "new").otherwise("skipped")).drop("_new")


def _numbered(new: DataFrame) -> DataFrame:
    """Article ids that follow day, batch and intake order."""
    ranked = ordinal_within(new.withColumn("_at", F.struct("source_ord", "pos")), "sample", "_at")
    day = F.datediff(sample_date(F.col("sample")), F.lit("1970-01-01").cast("date")).cast("long")
    batch = sample_batch(F.col("sample"))
    base = (day * 1000 + batch) * 10_000_000_000
    fits = (batch < 1000) & (F.col("ordinal") < 10_000_000_000)
    number = F.when(fits, base + F.col("ordinal")).otherwise(F.raise_error(F.lit("batch or ordinal beyond the range of article ids")).cast("long"))
    return ranked.withColumn("article_id", number).drop("_at", "ordinal")


def _shares(done: DataFrame, kind: str) -> Column:
    rows = F.collect_list(
        F.when(F.col("kind") == kind, F.struct((-F.col("n")).alias("o"), "label", F.col("percentage").cast("double").alias("percentage")))
    )
    return F.transform(F.sort_array(rows), lambda r: F.struct(r["label"].alias("label"), r["percentage"].alias("percentage")))


def gather(
    raw: DataFrame,
    pool: DataFrame,
    sample: str,
    as_of: Column,
    polarity: DataFrame,
    topics: DataFrame | None = None,
    models: Models = Models(),
) -> Gathered:
    """One run over the united sources. The gate comes before the models, so seen articles cost no model call."""
    spark = raw.sparkSession
    topics = topic_lexicon(spark, TOPICS) if topics is None else topics
    rows = candidates(raw).withColumn("sample", F.lit(sample)).withColumn("batch", sample_batch(F.col("sample")))
    for name, kind in (("published_at", "timestamp"), ("category", "string")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    marked = cut(admit(cut(rows), pool))  # read twice: what comes from unordered sources must not be numbered anew
    new = _numbered(marked.where("status = 'new'").drop("status"))
    # Model results feed four outputs and are computed once.
    done = cut(classify(new, topics, polarity, models).withColumn("created_at", as_of.cast("timestamp")))
    ok = done.where("status = 'ok'")
    articles = ok.select(
        "article_id", "title", "url", "text", "summary", "source", "scraped_at", "published_at", "category", "batch", "topic",
        "sentiment", F.lit(False).alias("isCleaned"), "status", "created_at", "sample",
    )
    summaries = articles.select("title", "url", "summary", "source", "scraped_at", "batch", "topic", "sentiment", "sample")
    outcomes = done.select("sample", "status").unionByName(marked.where("status = 'skipped'").select("sample", "status"))
    counted = outcome_counts(outcomes).select(F.struct("successfully", "unsuccessfully", "skipped").alias("articles_processed"))
    spread = sample_distributions(ok).agg(
        _shares(ok, "topic").alias("topic_distribution"), _shares(ok, "sentiment").alias("sentiment_distribution")
    )
    meta = side_by_side(counted, spread).select(
        F.lit(sample).alias("sample"), sample_batch(F.lit(sample)).alias("batch"), "*",
        as_of.cast("timestamp").alias("gathering_started_at"), as_of.cast("timestamp").alias("gathering_finished_at"),
    )
    marks = done.select("url", "sample", "created_at")  # failed rows are marked too, so that they are not tried forever
    return Gathered(articles, summaries, links.mark_processed(pool, marks), meta, marks)


def run_days(
    tables: Tables, source: Callable[[date], DataFrame], start: date, end: date, polarity: DataFrame, batch: int = 1, models: Models = Models(), dry_run: bool = False
) -> dict[str, str | None]:
    """Gather every day from ``start`` to ``end``, both included; returns per sample None, or why it failed.

    ``source`` gives the rows of a day. A day that fails does not keep the others from running, and a later call may
    repeat any day, since stored rows of its sample are replaced. A dry run only names the samples.
    """
    days = [r["date"] for r in date_spine(tables.spark, start, end).orderBy("date").collect()]
    failed: dict[str, str | None] = {}
    for day in days:
        sample = f"{batch}-{day.isoformat()}"
        failed[sample] = None
        if not dry_run:
            try:
                run_gather(tables, source(day), sample, F.lit(day.isoformat()).cast("timestamp"), polarity, models)
            except Exception as error:  # noqa: BLE001
                failed[sample] = f"{type(error).__name__}: {error}"
    return failed


def run_gather(tables: Tables, raw: DataFrame, sample: str, as_of: Column, polarity: DataFrame, models: Models = Models(), persist: bool = True) -> Gathered:
    """Gather into the stored tables and chain the sample to the one before it."""
    from newstide.operators.samples import latest_sample

    meta = tables.read("metadata")
    raw = cut(raw)  # read for its urls first: of the pool only their rows are wanted
    out = gather(raw, tables.links_of(raw), sample, as_of, polarity, models=models)
    if persist:
        before = latest_sample(meta.where(F.col("sample") != sample)).first()
        prev = before["sample"] if before else None
        # Safe to repeat after a stop: rows of the same sample and url are replaced.
        tables.upsert("articles", out.articles, ["sample", "url"])
        tables.upsert("summaries", out.summaries, ["sample", "url"])
        tables.append("link_marks", links.as_marks(out.marks, as_of))
        tables.upsert("metadata", out.metadata.withColumn("prev", F.lit(prev)), ["sample"])
        if prev:
            known = tables.read("metadata")
            tables.rewrite("metadata", known.withColumn("next", F.when(F.col("sample") == prev, F.lit(sample)).otherwise(F.col("next"))))
        return replace(out, link_pool=tables.read("link_pool"))  # the old files are gone
    return out
