"""Duplicate handling by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newstide.functions.text import strip
from newstide.session import broadcast_if_small, side_by_side

KEYS = {"sample_url": ["sample", "url"], "url": ["url"]}


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key.

    A filter on rank 1 makes Spark reduce every task to one row per key before
    the shuffle, so a key that holds a large share of the rows stays cheap.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def dedup_in_run(df: DataFrame, order: tuple[str, ...] = ("source_ord", "pos")) -> DataFrame:
    """Keep the first row of each url in intake order."""
    return first_by(df, ["url"], [F.col(c).asc() for c in order])


def with_group_key(clean: DataFrame, key: str = "sample_url", sample: str | None = None) -> DataFrame:
    rows = clean if sample is None else clean.where(F.col("sample") == sample)
    for name in KEYS[key]:
        rows = rows.withColumn(f"key_{name}", F.coalesce(strip(F.col(name)), F.lit("")))
    return rows


def key_columns(key: str) -> list[str]:
    return [f"key_{name}" for name in KEYS[key]]


def duplicate_groups(
    clean: DataFrame, key: str = "sample_url", sample: str | None = None, limit: int = 0
) -> DataFrame:
    """Keys held by more than one row, with the row count; the first ``limit`` keys if given."""
    cols = key_columns(key)
    groups = with_group_key(clean, key, sample).groupBy(*cols).agg(F.count("*").alias("cnt")).where("cnt > 1")
    return groups.orderBy(*cols).limit(limit) if limit > 0 else groups


def dedupe(
    clean: DataFrame,
    key: str = "sample_url",
    keep: str = "oldest",
    sample: str | None = None,
    limit: int = 0,
    id_col: str = "article_id",
) -> DataFrame:
    """The rows left after each duplicate group is reduced to its oldest or newest row.

    With a ``sample`` only that sample is reduced, with a ``limit`` only the first
    groups; all other rows stay.
    """
    cols = key_columns(key)
    marked = with_group_key(clean, key)
    in_scope = F.lit(True) if sample is None else F.coalesce(F.col("sample") == sample, F.lit(False))
    if limit > 0:
        chosen = broadcast_if_small(duplicate_groups(clean, key, sample, limit).select(*cols, F.lit(True).alias("_hit")))
        marked = marked.join(chosen, cols, "left")
        in_scope = in_scope & F.coalesce("_hit", F.lit(False))
    ordering = [F.col("created_at"), F.col(id_col)]
    if keep == "newest":
        ordering = [c.desc() for c in ordering]
    marked = marked.withColumn("_in", in_scope)
    kept = first_by(marked.where("_in"), cols, ordering).unionByName(marked.where("not _in"))
    return kept.select(*clean.columns)


def dedupe_report(clean: DataFrame, key: str = "sample_url", sample: str | None = None, limit: int = 0) -> DataFrame:
    """One row: groups found, groups handled, rows kept and rows deleted."""
    found = duplicate_groups(clean, key, sample).agg(F.count("*").alias("groups_found"))
    handled = duplicate_groups(clean, key, sample, limit).agg(
        F.count("*").alias("groups_handled"),
        F.count("*").alias("kept"),
        F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).alias("deleted"),
    )
    return side_by_side(found, handled)


def uniqueness_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that break uniqueness, exactly as stored."""
    return df.groupBy(*columns).agg(F.count("*").alias("cnt")).where("cnt > 1")


def assert_unique(df: DataFrame, columns: list[str]) -> None:
    """Refuse a write whose key is not unique."""
    bad = uniqueness_violations(df, columns).limit(1).collect()
    if bad:
        raise ValueError(f"{columns} is not unique, for example {bad[0].asDict()}")
