"""Upkeep of the stored tables: duplicates, stale rows, state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.operators import maintenance, stats
from newstide.operators.dedup import dedupe, dedupe_report
from newstide.operators.samples import latest_samples
from newstide.sources.tables import Tables


def run_dedupe(tables: Tables, key: str = "sample_url", keep: str = "oldest", sample: str | None = None, limit: int = 0, dry_run: bool = False) -> dict:
    """Reduce duplicates of the clean articles; returns what was found, kept and deleted."""
    clean = tables.read("clean_articles")
    report = dedupe_report(clean, key, sample, limit).first().asDict()
    if not dry_run and report["deleted"]:
        kept = dedupe(clean, key, keep, sample, limit).select("article_id").withColumn("_kept", F.lit(True))
        gone = clean.join(kept, "article_id", "left_anti").select("article_id", "sample")
        touched = [r[0] for r in gone.select("sample").distinct().collect()]
        left = clean.where(F.col("sample").isin(touched)).join(gone.select("article_id"), "article_id", "left_anti")
        tables.rewrite("clean_articles", left.select(*clean.columns))
    return report


def run_prune(tables: Tables, as_of: Column, days: int = 7) -> dict:
    """Delete stale rows of the three tables; returns the counts and the cutoff."""
    limit = maintenance.cutoff(as_of, days)
    names = {"link_pool": "link_pool_deleted", "articles": "articles_deleted", "clean_articles": "clean_deleted"}
    out = {names[t]: tables.delete(t, maintenance.RULES[t](limit)) for t in names}
    out["cutoff"] = tables.spark.range(1).select(F.date_format(limit, "yyyy-MM-dd HH:mm:ss")).first()[0]
    return out


def inspect_state(tables: Tables, limit_samples: int = 5) -> dict[str, DataFrame]:
    """Latest metadata, counts per sample, backlog and top sources."""
    meta, articles, clean = (tables.read(t) for t in ("metadata", "articles", "clean_articles"))
    latest = latest_samples(meta, limit_samples)
    return {
        "latest_meta": meta.join(latest.select("sample"), "sample"),
        "per_sample_counts": stats.per_sample_counts(latest, articles, clean),
        "backlog": stats.backlog_counts(articles, clean),
        "top_sources": stats.top_sources(articles),
    }
