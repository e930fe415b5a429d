"""The stream's link pool: several batches, a restart, and the rules of the stored pool."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from newstide.streaming.intake import run_available, table_stream
from newstide.streaming.pool import STORE, rocks_state, through_pool

SCHEMA = "url string, seen_at timestamp, done boolean"
DAY0 = datetime(2025, 8, 1)


def run(spark, folder, batches, days=7):
    """Each batch lands as a file of its own and is read by a query that was restarted."""
    out, state, path = (str(folder / n) for n in ("out", "state", "in"))
    for batch in batches:
        rows = [(u, DAY0 + timedelta(days=d) if d is not None else None, done) for u, d, done in batch]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        with rocks_state(spark):
            run_available(through_pool(table_stream(spark, path, spark.createDataFrame([], SCHEMA).schema), "seen_at", F.col("done"), days), out, state)
    got = spark.read.schema("url string, at timestamp, times int").parquet(out).collect()
    return sorted((r.url, (r.at - DAY0).total_seconds() / 86400) for r in got)


def test_rules_over_batches(spark, tmp_path):
    before = spark.conf.get(STORE)
    batches = [
        [("open", 0, False), ("done", 0, False), ("edge", 0, None), ("open", 1, False), (None, 1, False), ("untimed", None, False), ("marked first", 0, True)],
        [("done", 2, True), ("open", 5, False), ("other", 6, False)],
        [("edge", 7, False), ("marked first", 6.5, False)],  # exactly seven days are not stale yet
        [("open", 7.5, False), ("done", 8, False)],
        [("done", 30, False), ("open", 30, False), ("other", 29.9, False), ("edge", 30, False), ("marked first", 31, False)],
    ]
    want = [("done", 0), ("edge", 0), ("edge", 30), ("open", 0), ("open", 7.5), ("open", 30), ("other", 6), ("other", 29.9)]
    assert run(spark, tmp_path, batches) == sorted((u, float(d)) for u, d in want)
    assert spark.conf.get(STORE) == before


def test_one_batch_and_hot_url(spark, tmp_path):
    """A third of all rows belong to one url; what one batch lets through is what many would."""
    hot = [("hot", i / 1000, False) for i in range(21_000)]
    rest = [(f"u{i % 300}", i / 1000, i % 7 == 0) for i in range(300)]
    got = run(spark, tmp_path, [hot + rest])
    assert [g for g in got if g[0] == "hot"] == [("hot", 0.0), ("hot", 7.001), ("hot", 14.002)]
    assert {g[0] for g in got} == {"hot"} | {f"u{i}" for i in range(300) if i % 7}
