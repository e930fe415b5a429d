"""Stored tables: change logs beside texts, the view of the day, vectors without a weight table, many days, uniqueness."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_pipelines import lexicons, now, raw, story

from newstide.config import ClusterConfig, EngineConfig
from newstide.operators import links
from newstide.plans import clean as CN
from newstide.plans import gather as GA
from newstide.plans import trends as TR
from newstide.sources.tables import Tables
from newstide.sources.union import union_sources

CFG = EngineConfig(clusters=ClusterConfig(distance=0.4, min_size=3))
POOL = "url string, is_articles_processed boolean, in_sample string, created_at timestamp"


def size_of(path: Path) -> int:
    return sum(p.stat().st_size for p in path.rglob("*.parquet"))


def files_of(path: Path) -> dict:
    return {str(p): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def day_rows(spark, name, n=3):
    return union_sources([raw(spark, *[(f"https://{name}.org/{i}", "T", story("mars", 5 + i)) for i in range(n)])])


def test_latest_mark_of_a_url(spark):
    t = lambda d: dt.datetime(2025, 8, d)
    rows = [
        ("a", None, None, t(3), t(3), 0), ("a", True, "1-2025-08-04", t(4), t(4), 0), ("a", None, None, t(5), t(5), 0),
        ("b", None, None, t(2), t(2), 0), ("b", None, None, t(1), t(1), 0),
        ("c", True, "s1", t(1), t(1), 0), ("c", False, "s2", t(1), t(1), 0), (None, True, "s", t(1), t(1), 0),
    ]
    got = {r.url: tuple(r)[1:] for r in links.latest(spark.createDataFrame(rows, POOL + ", marked_at timestamp, bucket int")).collect()}
    assert got == {"a": (True, "1-2025-08-04", t(3)), "b": (None, None, t(1)), "c": (False, "s2", t(1)), None: (True, "s", t(1))}


def test_log_equals_rewriting_the_pool(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    pool = spark.createDataFrame([("a", None, None, dt.datetime(2025, 8, 1)), ("b", True, "x", dt.datetime(2025, 8, 1))], POOL)
    tables.rewrite("link_pool", pool)
    done = spark.createDataFrame([("a", "s", dt.datetime(2025, 8, 2)), ("c", "s", dt.datetime(2025, 8, 2)), ("c", "t", dt.datetime(2025, 8, 3))], "url string, sample string, created_at timestamp")
    tables.append("link_marks", links.as_marks(done))
    want = sorted(map(tuple, links.mark_processed(pool, done).collect()))
    assert sorted(map(tuple, tables.read("link_pool").collect())) == want
    assert sorted(map(tuple, tables.links_of(done.select("url")).collect())) == [r for r in want if r[0] in ("a", "c")]
    tables.compact_links()
    assert sorted(map(tuple, tables.read("link_pool").collect())) == want and spark.read.parquet(tables.path("link_marks")).count() == 3
    assert tables.delete("link_pool", F.col("url") == "b") == 1 and {r.url for r in tables.read("link_pool").collect()} == {"a", "c"}


def test_a_run_writes_in_proportion_to_its_batch(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    old = spark.range(200_000).select(F.concat(F.lit("https://old.org/"), "id").alias("url"), F.lit(True).alias("is_articles_processed"), F.lit("0-2025-08-01").alias("in_sample"), now().alias("created_at"))
    tables.rewrite("link_pool", old)
    links_path = tmp_path / "link_marks"
    before, whole = files_of(links_path), size_of(links_path)
    seen = raw(spark, ("https://old.org/77", "seen", story("mars")))
    GA.run_gather(tables, union_sources([day_rows(spark, "new"), seen]), "1-2025-08-10", now(), lexicons(spark)[1])
    assert before.items() <= files_of(links_path).items()  # nothing is written again
    assert size_of(links_path) - whole < 20_000 < whole / 20
    assert tables.read("articles").count() == 3 and tables.read("link_pool").count() == 200_003
    texts = files_of(tmp_path / "articles")
    CN.run_clean(tables, "1-2025-08-10", now())
    assert tables.read("articles").where("isCleaned").count() == 3
    cleaned = files_of(tmp_path / "clean_articles")
    TR.run_daily_words(tables, "1-2025-08-10", now(), mark=True)
    assert tables.read("clean_articles").where("isProcessed").count() == 3
    assert files_of(tmp_path / "articles") == texts and files_of(tmp_path / "clean_articles") == cleaned  # flags lie beside the texts
    CN.run_clean(tables, "1-2025-08-10", now())  # rows written anew come with their own flag
    assert tables.read("clean_articles").where("isProcessed").count() == 0 and tables.read("articles").where("isCleaned").count() == 3


def test_view_of_the_day_beside_the_threads(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    mood = lexicons(spark)[1]
    for day, name in (("2025-08-10", "a"), ("2025-08-11", "b")):
        at = F.lit(f"{day} 12:00:00").cast("timestamp")
        GA.run_gather(tables, day_rows(spark, name), f"1-{day}", at, mood)
        CN.run_clean(tables, f"1-{day}", at)
        for _ in range(2):
            TR.run_trends(tables, f"1-{day}", at, CFG)
    view, threads = tables.read("daily_threads"), tables.read("trend_threads")
    assert set(view.columns) == set(TR.DAILY)
    rows = lambda df: sorted(str(tuple(r)) for r in df.select(*TR.DAILY).collect())
    assert view.count() == 2 and rows(view) == rows(threads)
    assert {r.thread_id for r in view.collect()} == {"thr-1-2025-08-10-0"}


def test_missing_vectors_are_made_or_refused(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    GA.run_gather(tables, day_rows(spark, "a"), "1-2025-08-10", now(), lexicons(spark)[1])
    CN.run_clean(tables, "1-2025-08-10", now())
    assert tables.read("term_weights").count() > 3
    whole = TR.run_trends(tables, "1-2025-08-10", now(), CFG, persist=False).first()
    clean = tables.read("clean_articles")
    first = clean.agg(F.min("article_id")).first()[0]
    tables.rewrite("clean_articles", clean.withColumn("embedding", F.when(F.col("article_id") != first, F.col("embedding"))))
    again = TR.run_trends(tables, "1-2025-08-10", now(), CFG, persist=False).first()
    assert again["size"] == whole["size"] == 3  # embedded anew with the stored weights
    dense = F.when(F.col("article_id") != first, F.array_repeat(F.lit(0.1).cast("float"), 12))
    other = Tables(spark, str(tmp_path / "dense"))
    other.append("clean_articles", tables.read("clean_articles").withColumn("embedding", dense))
    with pytest.raises(ValueError, match="lack a usable vector"):
        TR.run_trends(other, "1-2025-08-10", now(), CFG)


def test_many_days(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    mood = lexicons(spark)[1]

    def source(day):
        if day.day == 11:
            raise OSError("feed is down")
        return day_rows(spark, f"d{day.day}", 2)

    start, end = dt.date(2025, 8, 10), dt.date(2025, 8, 12)
    assert GA.run_days(tables, source, start, end, mood, dry_run=True) == {f"1-2025-08-{d}": None for d in (10, 11, 12)}
    assert tables.read("articles").count() == 0
    for _ in range(2):  # repeated days find their links seen and keep their articles
        out = GA.run_days(tables, source, start, end, mood)
        assert {s for s, error in out.items() if error} == {"1-2025-08-11"} and "feed is down" in out["1-2025-08-11"]
    assert sorted(r["sample"] for r in tables.read("articles").select("sample").collect()) == ["1-2025-08-10"] * 2 + ["1-2025-08-12"] * 2
    with pytest.raises(ValueError):
        GA.run_days(tables, source, end, start, mood)


def test_append_looks_at_stored_rows(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    rows = spark.createDataFrame([("thr-1", "2025-08-10"), (None, "2025-08-10")], "thread_id string, date string")
    tables.append("trend_threads", rows, ["date", "thread_id"])
    for again in ("thr-1", None):
        with pytest.raises(ValueError, match="stored already"):
            tables.append("trend_threads", spark.createDataFrame([(again, "2025-08-10")], rows.schema), ["date", "thread_id"])
    tables.append("trend_threads", spark.createDataFrame([("thr-1", "2025-08-11")], rows.schema), ["date", "thread_id"])
    assert tables.read("trend_threads").count() == 3


def test_partitions_are_emptied_whatever_their_value(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "a b"))
    rows = [("x", "1-2025-08-10"), ("y", None), ("z", "odd:/ %41"), ("x", "1-2025-08-11"), ("w", "1-2025-08-11")]
    tables.append("summaries", spark.createDataFrame(rows, "url string, sample string"))
    assert tables.delete("summaries", F.col("url").isin("x", "y", "z")) == 4
    assert [tuple(r) for r in tables.read("summaries").collect()] == [("w", "1-2025-08-11")]
