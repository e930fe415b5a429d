"""Runs that are repeated, models that are injected singly, and words a stored weight table has not seen."""

from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from newstide.operators import models as MD
from newstide.plans import clean as CN
from newstide.plans import gather as GA
from newstide.plans import trends as TR
from newstide.sources import tables as TB
from newstide.sources.tables import Tables
from newstide.sources.union import union_sources

NOW = datetime(2025, 8, 10, 8)


def now():
    return F.lit("2025-08-10 09:00:00").cast("timestamp")


def texts(spark, *rows):
    return spark.createDataFrame(list(enumerate(rows)), "article_id long, text string").withColumn("summary", F.lit(None).cast("string"))


def test_unseen_words_are_kept(spark):
    idf = MD.fit_idf(texts(spark, "apples and pears", "apples and plums"))
    got = {r.article_id: r.vec for r in MD.embed_text(texts(spark, "rockets engines", "apples rockets", "apples"), idf).collect()}
    assert set(got) == {0, 1, 2} and len(got[0]["values"]) == 2 and len(got[1]["values"]) == 2
    known, unseen = sorted(got[1]["values"])
    assert abs(unseen / known - (1 + __import__("math").log(3)) / 1.0) < 1e-9  # ln((1 + 2) / 1) + 1 against ln(3 / 3) + 1
    empty = MD.fit_idf(texts(spark).where("false"))
    assert MD.embed_text(texts(spark, "a word"), empty).count() == 1


def test_last_sentence_can_win():
    text = " ".join(f"A{i} b{i} c{i} d{i}." for i in range(40)) + " Rocket rocket rocket."
    assert "Rocket rocket rocket." in MD.salient_sentences(text, 12, 3)
    words = " ".join(f"w{i}" for i in range(1200)) + " " + "tail " * 400
    assert "tail" in MD.summarize_text(words, MD.salient_sentences, lambda t: len(t.split()))


def lexicons(spark):
    topics = spark.createDataFrame([("rocket", "space", 1.0)], "word string, topic string, weight double")
    return topics, spark.createDataFrame([("good", 1)], "word string, polarity int")


def test_one_injected_model_is_used(spark):
    topics, mood = lexicons(spark)
    rows = texts(spark, "a good rocket", "nothing")
    own_topic = MD.Models(topic=lambda: lambda t: {"labels": ["mine"], "scores": [1.0]})
    got = {r.article_id: r for r in MD.classify(rows, topics, mood, own_topic).collect()}
    assert {r.topic for r in got.values()} == {"mine"} and got[0].sentiment.label == "POSITIVE" and got[1].sentiment.label == "unknown"
    own_mood = MD.Models(sentiment=lambda: lambda t: {"label": "MINE", "score": 0.5})
    got = {r.article_id: r for r in MD.classify(rows, topics, mood, own_mood).collect()}
    assert {r.sentiment.label for r in got.values()} == {"MINE"} and got[0].topic == "space" and got[1].topic == "unknown"


def test_summariser_is_made_once_per_task(spark):
    made = spark.sparkContext.accumulator(0)

    def factory():
        made.add(1)
        return lambda text, longest, shortest: text[:longest]

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        rows = spark.range(0, 100, 1, 2).select(F.col("id").alias("article_id"), F.repeat(F.lit("word. "), 60).alias("text"))
        MD.summarize(rows, models=MD.Models(summariser=factory)).write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert made.value == 2


def test_every_step_twice(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    _, mood = lexicons(spark)
    rows = [(f"https://a.org/{i}", f"T{i}", " ".join(f"shared{k}" for k in range(40)) + f" good rocket number{i}", "src", NOW) for i in range(6)]
    raw = union_sources([spark.createDataFrame(rows, "url string, title string, text string, source string, scraped_at timestamp")])
    sample = "1-2025-08-10"
    GA.run_gather(tables, raw, sample, now(), mood)
    idf = MD.fit_idf(tables.read("articles").withColumn("summary", F.lit(None).cast("string")))
    for _ in range(2):
        CN.run_clean(tables, sample, now(), idf)
        assert tables.read("clean_articles").count() == 6 and tables.read("articles").where("isCleaned").count() == 6
    TR.run_daily_words(tables, sample, now(), limit=5, persist=True)
    TR.run_daily_words(tables, sample, now(), limit=2, persist=True)
    ranks = sorted(r["rank"] for r in tables.read("daily_words").collect())
    assert ranks == [1, 2]
    counts = []
    for _ in range(2):
        TR.run_trends(tables, sample, now(), idf=idf)
        counts.append(tables.read("trend_threads").count())
    assert counts[0] == counts[1] > 0


def test_only_a_missing_table_reads_as_empty(spark, tmp_path, monkeypatch):
    tables = Tables(spark, str(tmp_path))
    assert tables.read("link_pool").count() == 0 and tables.read("clean_articles") is None
    spark.range(3).write.parquet(tables.path("metadata"))
    monkeypatch.setitem(TB.LAYOUT, "metadata", ("not a schema at all(", None))
    with pytest.raises(Exception) as error:
        tables.read("metadata")
    assert not isinstance(error.value, AnalysisException) or error.value.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
