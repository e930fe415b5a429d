"""Several sources as one intake."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A source is any callable that gives a DataFrame with url, title, text, source and scraped_at.
Source = Callable[[SparkSession], DataFrame]


def union_sources(frames: list[DataFrame], pos: str | None = None) -> DataFrame:
    """Concatenate sources, keeping their order in ``source_ord`` and ``pos``.

    ``pos`` names a column that orders the rows of a source; without it the row
    order of the read is used.
    """
    marked = [
        df.withColumn("source_ord", F.lit(i)).withColumn(
            "pos", F.col(pos).cast("long") if pos else F.monotonically_increasing_id()
        )
        for i, df in enumerate(frames)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)


def read_sources(spark: SparkSession, sources: list[Source], pos: str | None = None) -> DataFrame:
    return union_sources([source(spark) for source in sources], pos)
