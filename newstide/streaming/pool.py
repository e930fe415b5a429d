"""The link pool as the state of a stream: a processed url never returns, any other returns once it is stale."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "url string, at timestamp, times int"


class LinkPool(StatefulProcessor):
    """State of one url: when it was tracked, how often it was let through, whether it is done.

    A row (url, at, done) with ``done`` says that the url was processed; any other row is a link. A link is let through when its
    url is unknown, or was tracked more than ``days`` before it and never processed. Rows of a url in one batch are
    taken by time within each chunk that Spark hands over (a link before a mark of the same time); nothing of a chunk is kept but the state.
    """

    def __init__(self, days: int = 7):
        self.keep = int(days * 86_400_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("link", "since long, times int, done boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        since, times, done = (self.state.get() if self.state.exists() else None) or (None, 0, False)
        before, through = (since, done), []
        for chunk in rows:
            marks = chunk["done"].fillna(False).astype(bool)
            micros = chunk["micros"].to_numpy()
            for i in sorted(range(len(chunk)), key=lambda i: (micros[i], marks.iloc[i])):
                at = int(micros[i])
                if marks.iloc[i]:
                    done = True
                    since = at if since is None else since
                elif not done and (since is None or at - since > self.keep):
                    since, times = at, times + 1
                    through.append((at, times))
        if (since, done) != before:
            self.state.update((since, times, done))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if not done:  # the first millisecond at which a link of this time would be let through again
                self.handle.registerTimer((since + self.keep) // 1000 + 1)
        if through:
            at = pd.to_datetime([t for t, _ in through], unit="us", utc=True)
            yield pd.DataFrame({"url": key[0], "at": at, "times": pd.array([n for _, n in through], dtype="int32")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The watermark has passed the time of a url that was never processed: it is forgotten."""
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


@contextmanager
def rocks_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which timers need; the session's setting is put back."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(STORE, before) if before else spark.conf.unset(STORE)


def through_pool(rows: DataFrame, time: str, done: Column, days: int = 7, late: str = "0 seconds") -> DataFrame:
    """Links of a stream that the pool lets through, as (url, at, times); ``times`` counts how often by now.

    ``rows`` has ``url`` and the event time ``time``; ``done`` marks rows that say the url was processed. Rows without url or time
    are left out. Rows over ``late`` behind the latest event of earlier batches are dropped by the watermark. ``times`` starts
    anew once a url was forgotten. Start the query inside ``rocks_state``.
    """
    marked = (
        rows.select("url", F.col(time).cast("timestamp").alias("at"), done.alias("done"))
        .where("url is not null and at is not null")
        .withWatermark("at", late)
        .withColumn("micros", F.unix_micros("at"))
    )
    return marked.groupBy("url").transformWithStateInPandas(LinkPool(days), OUTPUT, "append", "eventTime")
