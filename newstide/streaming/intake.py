"""Continuous intake: landed files, url dedup with expiry, idempotent writes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newstide import schemas
from newstide.operators.filters import candidates
from newstide.sources.tables import Tables


def feed_stream(spark: SparkSession, path: str, files_per_batch: int = 1000, multi_line: bool = False) -> DataFrame:
    """Entries of feed result pages as they land."""
    pages = (
        spark.readStream.schema(schemas.FEED_PAGE)
        .option("multiLine", multi_line)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )
    return pages.select("category", F.explode("articles").alias("a")).select("category", "a.*")


def table_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def first_seen(rows: DataFrame, time: str = "scraped_at", keep: str = "7 days") -> DataFrame:
    """Candidates whose url was not seen within ``keep``.

    The state holds one entry per url and expires with the watermark, processed or
    not, where the stored link pool keeps processed urls for good.
    """
    return candidates(rows).withWatermark(time, keep).dropDuplicatesWithinWatermark(["url"])


def run_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what has landed and stop; a restart with the same checkpoint goes on from there."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query


def upsert_each_batch(stream: DataFrame, tables: Tables, name: str, keys: list[str], checkpoint: str,
                      prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Write every micro-batch as an upsert, so a batch that is tried again changes nothing."""
    query = (
        stream.writeStream.foreachBatch(lambda df, _: tables.upsert(name, prepare(df), keys))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
