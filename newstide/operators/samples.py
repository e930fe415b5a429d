"""Batches and samples: numbering, order and neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newstide.functions.samples import date_key, is_well_formed, sample_batch, sample_date, sample_id


def distinct_samples(df: DataFrame, text: str) -> DataFrame:
    """Samples whose id contains the text, ignoring case."""
    return df.where(F.col("sample").ilike("%" + text.replace("%", r"\%").replace("_", r"\_") + "%")).select("sample").distinct()


def next_batch(samples: DataFrame, dates: DataFrame) -> DataFrame:
    """(date, next_batch, next_sample) for each date of ``dates``; 1 when the date has no sample."""
    known = (
        samples.select(sample_date(F.col("sample")).alias("date"), sample_batch(F.col("sample")).alias("b"))
        .where("date is not null and b is not null")
        .groupBy("date")
        .agg(F.max("b").alias("b"))
    )
    number = (F.coalesce("b", F.lit(0)) + 1).cast("int")
    return dates.select("date").distinct().join(known, "date", "left").select(
        "date", number.alias("next_batch"), sample_id(date_key(F.col("date")), number).alias("next_sample")
    )


def _ordered(samples: DataFrame) -> DataFrame:
    s = F.col("sample")
    return (
        samples.where(is_well_formed(s))
        .select(s, sample_date(s).alias("date"), sample_batch(s).alias("batch"))
        .distinct()
    )


def latest_sample(samples: DataFrame) -> DataFrame:
    """The newest sample by (date, batch); unreadable ids are ignored."""
    return _ordered(samples).agg(F.max_by("sample", F.struct("date", "batch")).alias("sample"))


def latest_samples(samples: DataFrame, limit: int = 5) -> DataFrame:
    return _ordered(samples).orderBy(F.desc("date"), F.desc("batch")).limit(limit)


def sample_chain(samples: DataFrame) -> DataFrame:
    """(sample, prev, next) in (date, batch) order.

    Neighbours within a day come from a window per day; the first and last sample
    of a day look to the days around it, a table of one row per day.
    """
    rows = _ordered(samples)
    day = Window.partitionBy("date").orderBy("batch")
    days = rows.groupBy("date").agg(
        F.min_by("sample", "batch").alias("first"), F.max_by("sample", "batch").alias("last")
    )
    year = F.year("date")
    in_year = Window.partitionBy(year).orderBy("date")
    around = days.select("date", F.lag("last").over(in_year).alias("day_before"), F.lead("first").over(in_year).alias("day_after"))
    # The edges of a year look to the nearest other year that has samples.
    years = days.groupBy(year.alias("y")).agg(F.min_by("first", "date").alias("y_first"), F.max_by("last", "date").alias("y_last"))
    pairs = Window.orderBy("y")
    years = years.select("y", F.lag("y_last").over(pairs).alias("y_before"), F.lead("y_first").over(pairs).alias("y_after"))
    return (
        rows.withColumn("prev", F.lag("sample").over(day))
        .withColumn("next", F.lead("sample").over(day))
        .join(around, "date")
        .withColumn("y", year)
        .join(years, "y")
        .select(
            "sample",
            F.coalesce("prev", "day_before", "y_before").alias("prev"),
            F.coalesce("next", "day_after", "y_after").alias("next"),
        )
    )


def date_spine(spark, start, end) -> DataFrame:
    """One row per day from start to end, both included; refuses a reversed range."""
    if start > end:
        raise ValueError("the end date must not lie before the start date")
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias("date"))


def backfill_dates(trends: DataFrame) -> DataFrame:
    """Set the date of stored rows to the date part of their sample."""
    return trends.withColumn("date", F.substring_index("sample", "-", -3))


def move_sample(df: DataFrame, old: str, new: str) -> DataFrame:
    """Give the rows of one sample to another."""
    return df.withColumn("sample", F.when(F.col("sample") == old, F.lit(new)).otherwise(F.col("sample")))
