"""Row filters of the intake and cleaning steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.config import UNWANTED_SNIPPETS
from newstide.functions.text import blank_to_null, strip, title_or_default


def candidates(raw: DataFrame) -> DataFrame:
    """Rows with a url and some text; text is stripped and an empty title replaced."""
    kept = raw.where((F.col("url") != "") & blank_to_null(F.col("text")).isNotNull())
    return kept.withColumn("text", strip(F.col("text"))).withColumn("title", title_or_default(F.col("title")))


def has_unwanted(content: Column, snippets: list[str] | None = None) -> Column:
    """True when the content holds any snippet, matching case; null content holds none."""
    hit = F.lit(False)
    for snippet in UNWANTED_SNIPPETS if snippets is None else snippets:
        hit = hit | F.coalesce(content, F.lit("")).contains(snippet)
    return hit


def publication_status(published_at: Column, target: Column) -> Column:
    """'kept' on the target date, 'skipped' on another, null for a missing or unreadable time."""
    day = F.to_date(F.try_to_timestamp(published_at, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")))
    return F.when(day == target, "kept").when(day.isNotNull(), "skipped")


def not_yet(flag: Column) -> Column:
    """False, null and missing all mean that the step has not been done."""
    return ~flag.eqNullSafe(F.lit(True))
