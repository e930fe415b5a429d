"""Models, stored tables, whole runs, feeds and streams."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from newstide.config import ClusterConfig, EngineConfig
from newstide.operators import models as MD
from newstide.operators.links import mark_processed
from newstide.plans import clean as CN
from newstide.plans import gather as GA
from newstide.plans import trends as TR
from newstide.plans import upkeep as UP
from newstide.sources import feeds as FD
from newstide.sources import pages as PG
from newstide.sources.tables import Tables, insert_missing, set_where, upsert
from newstide.sources.union import read_sources, union_sources
from newstide.streaming import intake as IN


def fake_topic():
    return lambda text: {"labels": ["technology and innovation", "business and finance"], "scores": [0.88, 0.12]}


def fake_sentiment():
    return lambda text: {"label": "POSITIVE", "score": 0.97}


def cut_to_length():
    return lambda text, longest, shortest: text[:longest]


FAKES = MD.Models(summariser=cut_to_length, topic=fake_topic, sentiment=fake_sentiment)
ART = "article_id long, title string, url string, text string, source string, scraped_at timestamp"
NOW = dt.datetime(2025, 8, 10, 12)


def now():
    return F.lit("2025-08-10 12:00:00").cast("timestamp")


def articles(spark, *texts):
    return spark.createDataFrame([(i, f"T{i}", f"https://e.org/{i}", t, "src", NOW) for i, t in enumerate(texts)], ART)


def lexicons(spark):
    topics = spark.createDataFrame([("chip", "technology and innovation", 1.0), ("bank", "business and finance", 1.0)], "word string, topic string, weight double")
    mood = spark.createDataFrame([("good", 1.0), ("bad", -1.0)], "word string, polarity double")
    return topics, mood


def test_classify_passes_fields_through(spark):
    df = articles(spark, "A short body of text about a new AI chip.")
    r = MD.classify(df, *lexicons(spark), FAKES).first()
    assert (r.title, r.url, r.text, r.summary) == ("T0", "https://e.org/0", "A short body of text about a new AI chip.", r.text)
    assert r.topic == "technology and innovation" and r.sentiment.label == "POSITIVE" and r.status == "ok"


def test_classify_long_text(spark):
    r = MD.classify(articles(spark, "lorem ipsum " * 5000), *lexicons(spark), FAKES).first()
    assert r.status == "ok" and len(r.summary) < 60000 and r.text == "lorem ipsum " * 5000


def test_classify_marks_failures(spark):
    def broken():
        def run(text):
            if "boom" in text:
                raise RuntimeError("no")
            return {"labels": []}
        return run

    models = MD.Models(topic=broken, sentiment=fake_sentiment)
    got = {r.article_id: (r.status, r.topic) for r in MD.classify(articles(spark, "fine", "boom"), *lexicons(spark), models).collect()}
    assert got == {0: ("ok", "unknown"), 1: ("failed", None)}


def test_default_classifiers(spark):
    df = articles(spark, "a good chip", "bad bad bank", "nothing", "chip bank", None)
    df = df.withColumn("summary", F.col("text"))
    topics, mood = lexicons(spark)
    got = {r.article_id: (r.topic, r.sentiment.label, r.sentiment.score) for r in MD.classify_sentiment(MD.classify_topic(df, topics), mood).collect()}
    assert got == {
        0: ("technology and innovation", "POSITIVE", 1.0), 1: ("business and finance", "NEGATIVE", 1.0), 2: ("unknown", "unknown", 0.0),
        3: ("business and finance", "unknown", 0.0), 4: ("unknown", "unknown", 0.0)}


def test_summaries():
    count = lambda t: len(t.split())
    calls = []

    def first(text, longest, shortest):
        calls.append((longest, shortest))
        return text[:longest]

    assert MD.summarize_text("Short article body.", first, count) == "Short article body." and not calls
    long = "Sentence. " * 2000
    short = MD.summarize_text(long, first, count)
    assert 0 < len(short) < len(long) and calls and calls[0] == (200, 80)
    many = "one two three four five six seven eight nine ten eleven twelve. " * 600
    assert len(MD._chunks(many, count, 512)) >= 2
    lead = MD.summarize_text(many, MD.leading_sentences, count)
    assert 0 < count(lead) <= 512

    def failing(text, longest, shortest):
        raise RuntimeError

    assert MD.summarize_text(long, failing, count) == ""


def test_python_chunks_equal_the_native_ones(spark):
    from newstide.functions.text import chunks

    text = " ".join(f"{'w ' * (i % 9)}end{'.!?'[i % 3]}" for i in range(60))
    assert spark.range(1).select(chunks(F.lit(text), 12)).first()[0] == MD._chunks(text, lambda t: len(t.split()), 12)


def test_choose_summary(spark):
    df = articles(spark, " short ", "x " * 300, "y " * 300).withColumn("summary", F.when(F.col("article_id") == 2, " kept "))
    got = {r.article_id: r.summary for r in MD.choose_summary(df, FAKES).collect()}
    assert got[0] == "short" and got[2] == "kept" and 0 < len(got[1]) < 600


def test_terms(spark):
    df = articles(spark, "The Dogs saw 3 dogs and x2", None)
    lexicon = spark.createDataFrame([("dogs", "Dog", "NOUN"), ("saw", "see", "VERB")], "word string, lemma string, pos string")
    assert [r.nouns for r in MD.extract_terms(df).orderBy("article_id").collect()][0] == ["dogs", "saw", "dogs"]
    assert [r.nouns for r in MD.extract_terms(df, lexicon).orderBy("article_id").collect()] == [["dog", "dog"], []]
    tagged = MD.extract_terms(df, models=MD.Models(tagger=lambda: lambda t: t.split()[:1]))
    assert [r.nouns for r in tagged.orderBy("article_id").collect()] == [["The"], []]


def test_default_vectors(spark):
    import math

    df = articles(spark, "apple apple pear", "apple", "...").withColumn("summary", F.lit(None).cast("string"))
    idf = MD.fit_idf(df)
    got = {r.article_id: dict(zip(r.vec.indices, r.vec["values"])) for r in MD.embed_text(df, idf).collect()}
    slot = {w: spark.range(1).select(F.pmod(F.xxhash64(F.lit(w)), F.lit(MD.DIMENSIONS))).first()[0] for w in ("apple", "pear")}
    apple, pear = 2 * (math.log(4 / 3) + 1), math.log(4 / 2) + 1
    length = math.hypot(apple, pear)
    assert set(got) == {0, 1} and math.isclose(got[1][slot["apple"]], 1.0, rel_tol=1e-6)
    assert math.isclose(got[0][slot["apple"]], apple / length, rel_tol=1e-6) and math.isclose(got[0][slot["pear"]], pear / length, rel_tol=1e-6)


def test_injected_embedder(spark):
    df = articles(spark, "aa", "b").withColumn("summary", F.lit(None).cast("string"))
    got = {r.article_id: r.vec for r in MD.embed_with(df, MD.Models(embedder=lambda: lambda texts: [[3.0 * len(t), 4.0 * len(t)] for t in texts])).collect()}
    assert [round(x, 5) for x in got[0]] == [0.6, 0.8] and len(got) == 2


def test_vectors_of_a_sample_never_mix(spark):
    rows = [(1, "s", [1.0] * 10), (2, "s", None), (3, "r", [2.0] * 10), (4, "q", [1.0] * 9)]
    df = spark.createDataFrame(rows, "article_id long, sample string, embedding array<double>")
    out = MD.resolve_vectors(df, lambda d: d.select("article_id", F.array(F.lit(9.0)).alias("vec")))
    got = {r.article_id: (r.reuse, len(r.vec)) for r in out.collect()}
    assert got == {1: (False, 1), 2: (False, 1), 3: (True, 10), 4: (False, 1)}


def test_upsert_and_insert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    assert {tuple(r) for r in upsert(old, new, ["k"]).collect()} == {("a", 1), ("b", 2), ("c", 2)}
    assert {tuple(r) for r in insert_missing(old, new, ["k"]).collect()} == {("a", 1), ("b", 1), ("c", 2)}
    once = upsert(old, new, ["k"])
    assert upsert(once, new, ["k"]).exceptAll(once).count() == 0
    assert {tuple(r) for r in set_where(old, new, ["k"], v=7).collect()} == {("a", 1), ("b", 7)}


def test_tables_rewrite_only_touched_partitions(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    schema = "thread_id string, ema double, date date"
    d = [dt.date(2025, 8, i) for i in (1, 2, 3)]
    assert t.read("trend_threads") is None and t.read("link_pool").count() == 0
    t.upsert("trend_threads", spark.createDataFrame([("a", 1.0, d[0]), ("b", 1.0, d[1])], schema), ["date", "thread_id"])
    before = {p.name for p in (tmp_path / "trend_threads" / "date=2025-08-01").glob("*.parquet")}
    for _ in range(2):
        t.upsert("trend_threads", spark.createDataFrame([("b", 2.0, d[1]), ("c", 3.0, d[2])], schema), ["date", "thread_id"])
    assert {(r.thread_id, r.ema) for r in t.read("trend_threads").collect()} == {("a", 1.0), ("b", 2.0), ("c", 3.0)}
    assert {p.name for p in (tmp_path / "trend_threads" / "date=2025-08-01").glob("*.parquet")} == before
    with pytest.raises(ValueError):
        t.upsert("trend_threads", spark.createDataFrame([("b", 2.0, d[1]), ("b", 3.0, d[1])], schema), ["date", "thread_id"])
    assert t.delete("trend_threads", F.col("ema") < 2) == 1
    assert t.delete("trend_threads", F.col("thread_id").isin("b", "c") & (F.col("ema") > 2.5)) == 1
    assert {r.thread_id for r in t.read("trend_threads").collect()} == {"b"}
    t.insert_missing("trend_threads", spark.createDataFrame([("b", 9.0, d[1]), ("z", 9.0, d[1])], schema), ["date", "thread_id"])
    assert {(r.thread_id, r.ema) for r in t.read("trend_threads").collect()} == {("b", 2.0), ("z", 9.0)}


def raw(spark, *rows):
    return spark.createDataFrame([(u, t, x, "src", NOW) for u, t, x in rows], "url string, title string, text string, source string, scraped_at timestamp")


def story(word, n=6):
    return f"The chip {word} is good news. " + f"{word} engine rocket fuel. " * n


def test_runs_over_stored_tables(spark, tmp_path):
    """Two days end to end: gather, clean, words, threads, upkeep."""
    tables = Tables(spark, str(tmp_path))
    mood = lexicons(spark)[1]
    day1 = union_sources([
        raw(spark, ("https://www.cnn.com/1", " A ", story("mars")), ("https://a.org/2", "", story("mars")), ("https://a.org/3", None, story("mars", 7)),
            (None, "no url", "x"), ("https://a.org/4", "empty", "  ")),
        raw(spark, ("https://a.org/2", "copy", "other"), ("https://b.org/5", "E", "bad weather in the harbour")),
    ])
    out = GA.run_gather(tables, day1, "1-2025-08-10", now(), mood)
    got = {r.url: r for r in tables.read("articles").collect()}
    assert set(got) == {"https://www.cnn.com/1", "https://a.org/2", "https://a.org/3", "https://b.org/5"}
    assert got["https://a.org/2"].title == "(untitled)" and got["https://www.cnn.com/1"].article_id < got["https://b.org/5"].article_id
    meta = tables.read("metadata").first()
    assert tuple(meta.articles_processed) == (4, 0, 1) and meta.batch == 1 and meta.prev is None
    assert {(x.label, x.percentage) for x in meta.sentiment_distribution} == {("POSITIVE", 75.0), ("NEGATIVE", 25.0)}
    assert out.summaries.count() == 4 and tables.read("link_pool").count() == 4

    idf = MD.fit_idf(tables.read("articles"))
    CN.run_clean(tables, "1-2025-08-10", now(), idf)
    assert tables.read("articles").where("isCleaned").count() == 4
    clean = {r.url: r for r in tables.read("clean_articles").collect()}
    assert clean["https://www.cnn.com/1"].source_domain == "www.cnn.com" and "engine" in clean["https://a.org/2"].nouns

    ranked = TR.run_daily_words(tables, "1-2025-08-10", now(), limit=3, persist=True, mark=True)
    assert [r.word for r in ranked.orderBy("rank").collect()] == ["mars", "engine", "fuel"]
    assert tables.read("clean_articles").where("isProcessed").count() == 4 and tables.read("daily_words").count() == 3
    assert tables.read("metadata").first().distinct_words > 5

    cfg = EngineConfig(clusters=ClusterConfig(distance=0.4, min_size=3))
    first = TR.run_trends(tables, "1-2025-08-10", now(), cfg).collect()
    assert [(r.thread_id, r["size"], r.novelty) for r in first] == [("thr-1-2025-08-10-0", 3, 1.0)]
    again = TR.run_trends(tables, "1-2025-08-10", now(), cfg).collect()
    assert [r.ema for r in again] == [r.ema for r in first] and tables.read("trend_threads").count() == 1

    tomorrow = F.lit("2025-08-11 12:00:00").cast("timestamp")
    day2 = union_sources([raw(spark, ("https://a.org/2", "seen", story("mars")), *[(f"https://c.org/{i}", "N", story("mars", 5 + i)) for i in range(3)])])
    GA.run_gather(tables, day2, "1-2025-08-11", tomorrow, mood)
    chain = {r.sample: (r.prev, r.next) for r in tables.read("metadata").collect()}
    assert chain == {"1-2025-08-10": (None, "1-2025-08-11"), "1-2025-08-11": ("1-2025-08-10", None)}
    CN.run_clean(tables, "1-2025-08-11", tomorrow, idf)
    dry = TR.run_trends(tables, "1-2025-08-11", tomorrow, cfg, persist=False).collect()
    assert tables.read("trend_threads").count() == 1
    second = TR.run_trends(tables, "1-2025-08-11", tomorrow, cfg).first()
    assert second.thread_id == "thr-1-2025-08-10-0" == dry[0].thread_id and 0 <= second.novelty < 1
    assert abs(second.ema - (0.7 * second.cluster_score_today + 0.3 * first[0].ema)) < 1e-9
    assert tables.read("trend_threads").count() == 2

    state = UP.inspect_state(tables)
    assert {(r["sample"], r["articles"], r["clean_articles"]) for r in state["per_sample_counts"].collect()} == {("1-2025-08-10", 4, 4), ("1-2025-08-11", 3, 3)}
    assert tuple(state["backlog"].first()) == (0, 3) and state["latest_meta"].count() == 2
    extra = tables.read("clean_articles").where("url = 'https://a.org/2'").withColumn("article_id", F.col("article_id") + 5)
    tables.append("clean_articles", extra)
    assert UP.run_dedupe(tables, dry_run=True)["deleted"] == 1 and tables.read("clean_articles").count() == 8
    assert UP.run_dedupe(tables) == {"groups_found": 1, "groups_handled": 1, "kept": 1, "deleted": 1}
    assert tables.read("clean_articles").count() == 7
    late = F.lit("2025-08-19 00:00:00").cast("timestamp")
    assert UP.run_prune(tables, late) == {"link_pool_deleted": 0, "articles_deleted": 0, "clean_deleted": 4, "cutoff": "2025-08-12 00:00:00"}
    assert tables.read("clean_articles").count() == 3


def test_gather_marks_failures_processed(spark):
    def broken():
        def run(text):
            raise RuntimeError
        return run

    pool = spark.createDataFrame([], "url string, is_articles_processed boolean, in_sample string, created_at timestamp")
    out = GA.gather(union_sources([raw(spark, ("u1", "t", "x"))]), pool, "2-2025-08-10", now(), lexicons(spark)[1], models=MD.Models(topic=broken, sentiment=fake_sentiment))
    assert out.articles.count() == 0 and out.link_pool.first().is_articles_processed is True
    assert tuple(out.metadata.first().articles_processed) == (0, 1, 0)


def write(path, name, text):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text)


def entry(url, title="T", content="ok", at="2025-08-10T01:00:00Z", source="Wire"):
    return {"url": url, "title": title, "content": content, "publishedAt": at, "source": {"name": source}}


def test_feeds(spark, tmp_path):
    page = {"articles": [
        entry("u1", " One "), entry("u2", content="A required part of this site couldnt load"), entry("", "no url"), entry("u3", at="2025-08-09T01:00:00Z"),
        entry("u4", at="yesterday"), entry("u5"), entry("u6", None)]}
    write(tmp_path / "feed" / "category=health", "p.json", json.dumps(page, indent=1))
    bodies = spark.createDataFrame([("u1", " body "), ("u2", "b"), ("u3", "b"), ("u4", "b"), ("u5", "  "), ("u6", "b")], "url string, text string")
    feed = FD.read_feed_json(spark, str(tmp_path / "feed"), multi_line=True)
    assert {(r.url, r.title, r.text) for r in FD.topical_feed(feed, bodies, now()).collect()} == {("u1", "One", "body"), ("u3", "T", "b"), ("u4", "T", "b"), ("u6", "", "b")}
    target = F.lit("2025-08-10").cast("date")
    assert {(r.url, r.category, r.published_at) for r in FD.category_feed(feed, bodies, now(), target).collect()} == {
        ("u1", "health", "2025-08-10T01:00:00Z"), ("u6", "health", "2025-08-10T01:00:00Z")}
    assert tuple(FD.category_feed_counts(feed, target).first()) == (5, 1)


def test_rss(spark, tmp_path):
    items = "<item><title> A </title><link>u1</link><description> text </description></item><item><title>B</title><link>u2</link></item>"
    write(tmp_path, "f.xml", f"<rss><channel>{items}</channel></rss>")
    rows = FD.read_rss(spark, str(tmp_path / "f.xml"))
    assert [(r.url, r.title, r.text, r.source) for r in FD.rss_with_summaries(rows, "wire", now()).collect()] == [("u1", "A", "text", "wire")]
    bodies = spark.createDataFrame([("u2", "body")], "url string, text string")
    assert [(r.url, r.text) for r in FD.rss_with_bodies(rows, bodies, "post", now()).collect()] == [("u2", "body")]


def test_pages(spark):
    html = "<title>T &amp; U</title><nav><a href='/x'>x</a></nav><article><h1>Head</h1><script>if(a<b)</script><!-- c --><p>One&nbsp;two &amp;lt;</p><p>Three</p></article><a class=\"k\" href=\"/n/1\"><b>Link</b></a><a href=\"https://o.org/2\">Out</a>"
    pages = spark.createDataFrame([(1, "https://h.org/p?q", html), (2, "https://h.org/e", "<p>no region</p>")], "page_id long, url string, html string")
    got = [r.text for r in PG.extract_article_text(pages).orderBy("page_id").collect()]
    assert got == ["Head\nOne two &lt;\nThree", None]
    assert [(r.url, r.title) for r in PG.harvest_links(pages).orderBy("pos").collect()] == [("https://h.org/n/1", "Link"), ("https://o.org/2", "Out")]
    assert [r.title for r in PG.harvest_links(pages, "/n").collect()] == ["Link"]
    assert PG.bodies(pages).count() == 1


def test_sources_are_callables(spark):
    rows = read_sources(spark, [lambda s: raw(s, ("u1", "a", "x")), lambda s: raw(s, ("u1", "b", "x")).withColumn("category", F.lit("war"))])
    assert [(r.source_ord, r.title, r.category) for r in rows.orderBy("source_ord").collect()] == [(0, "a", None), (1, "b", "war")]


def test_stream_equals_batch_and_goes_on(spark, tmp_path):
    feed, out, state = tmp_path / "feed", str(tmp_path / "out"), str(tmp_path / "state")
    write(feed, "1.json", json.dumps({"category": "war", "articles": [entry("u1"), entry("u2")]}))
    stream = lambda: IN.feed_stream(spark, str(feed)).select("url", "title")
    IN.run_available(stream(), out, state)
    batch = FD.read_feed_json(spark, str(feed)).select("url", "title")
    assert spark.read.parquet(out).exceptAll(batch).count() == 0 and spark.read.parquet(out).count() == 2
    write(feed, "2.json", json.dumps({"category": "war", "articles": [entry("u3")]}))
    IN.run_available(stream(), out, state)
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["u1", "u2", "u3"]


def test_stream_drops_urls_seen_before(spark, tmp_path):
    feed, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    schema = "url string, title string, text string, scraped_at timestamp"

    def land(*rows):
        spark.createDataFrame([(u, "t", "x", at) for u, at in rows], schema).coalesce(1).write.mode("append").parquet(str(feed))

    def run():
        IN.run_available(IN.first_seen(IN.table_stream(spark, str(feed), spark.read.parquet(str(feed)).schema)).select("url", "scraped_at"), out, state)

    land(("u1", NOW), ("u1", NOW), ("u2", NOW))
    run()
    land(("u1", NOW + dt.timedelta(days=3)), ("u3", NOW + dt.timedelta(days=30)))
    run()
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["u1", "u2", "u3"]


def test_stream_upsert_is_idempotent(spark, tmp_path):
    feed = tmp_path / "in"
    tables = Tables(spark, str(tmp_path / "tables"))
    spark.createDataFrame([("a", 1.0, dt.date(2025, 8, 1)), ("b", 1.0, dt.date(2025, 8, 1))], "thread_id string, ema double, date date").write.parquet(str(feed))
    for run in range(2):
        stream = IN.table_stream(spark, str(feed), "thread_id string, ema double, date date")
        IN.upsert_each_batch(stream, tables, "trend_threads", ["date", "thread_id"], str(tmp_path / f"state{run}"))
    assert tables.read("trend_threads").count() == 2


def test_mark_processed_needs_no_prior_row(spark):
    pool = spark.createDataFrame([], "url string, is_articles_processed boolean, in_sample string, created_at timestamp")
    assert mark_processed(pool, spark.createDataFrame([("u", "s", NOW)], "url string, sample string, created_at timestamp")).count() == 1
