"""Hand-worked cases: ties, nulls, empty input, rounding and the rules of each operator."""

import datetime as dt
import math
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newstide.config import EngineConfig, ScoringConfig, TrendsConfig, config_from
from newstide.functions import samples as S
from newstide.functions import scoring as SCF
from newstide.functions import text as TX
from newstide.functions import urls as U
from newstide.functions import vectors as VX
from newstide.operators import dedup, filters, labels, links, maintenance, scan, scores, stats, threads, words
from newstide.operators import samples as SM


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def L(v):
    return F.lit(v)


def ts(text):
    return F.lit(text).cast("timestamp")


CLEAN = "sample string, topic string, sentiment struct<label:string,score:double>, nouns array<string>"


def test_daily_words_ranks_ties_by_word_and_handles_missing_labels(spark):
    rows = [
        ("s", " Health ", ("POSITIVE", 0.9), ["b", "a", "a", "c"]),
        ("s", "health", None, ["b"]),
        ("s", "unknown", ("n/a", 0.1), ["d", "d", "d"]),
        ("s", None, ("negative", 0.1), None),
        ("s", "war", ("NEGATIVE", 0.1), ["a"]),
    ]
    got = [tuple(r) for r in words.daily_words(spark.createDataFrame(rows, CLEAN), 3).orderBy("rank", "kind", "label").collect()]
    assert got == [
        ("s", 1, "a", 3, "sentiment", "negative", 1, 33),
        ("s", 1, "a", 3, "sentiment", "positive", 2, 67),
        ("s", 1, "a", 3, "topic", "health", 2, 67),
        ("s", 1, "a", 3, "topic", "war", 1, 33),
        ("s", 2, "d", 3, "none", None, None, None),
        ("s", 3, "b", 2, "sentiment", "positive", 1, 100),
        ("s", 3, "b", 2, "topic", "health", 2, 100),
    ]


def test_percentages_round_half_to_even(spark):
    rows = [("s", t, None, ["w"]) for t in ["x"] * 1 + ["y"] * 7] + [("s", t, None, ["v"]) for t in ["x"] * 3 + ["y"] * 5]
    got = {(r.word, r.label): r.percentage for r in words.daily_words(spark.createDataFrame(rows, CLEAN)).collect()}
    assert got == {("w", "x"): 12, ("w", "y"): 88, ("v", "x"): 38, ("v", "y"): 62}  # 12.5, 87.5, 37.5, 62.5


def test_nested_words_keep_largest_share_first(spark):
    rows = [("s", "war", None, ["w"])] + [("s", "health", None, ["w"])] * 2
    r = words.daily_words_nested(spark.createDataFrame(rows, CLEAN)).first()
    assert [(x.label, x.percentage) for x in r.topics] == [("health", 67), ("war", 33)] and r.sentiments == []


def test_word_totals(spark):
    rows = [("s", "t", None, ["a", "b", "a"]), ("s", "t", None, []), ("r", "t", None, ["a"])]
    df = spark.createDataFrame(rows, CLEAN)
    assert {tuple(r) for r in words.word_metrics(df).collect()} == {("s", 3, 2), ("r", 1, 1)}
    assert words.daily_words(df.where("false")).count() == 0


def test_strip_and_titles(spark):
    assert one(spark, TX.strip(L("　 a b\n")), TX.title_or_default(L(" \t")), TX.title_or_default(L(None).cast("string")), TX.title_or_default(L(" x "))) == (
        "a b", "(untitled)", "(untitled)", "x")


def test_coerce_text_by_type(spark):
    string, binary = T.StringType(), T.BinaryType()
    pair = T.StructType([T.StructField("text", T.ArrayType(string)), T.StructField("title", string)])
    assert one(
        spark,
        TX.coerce_text(L(None).cast("string"), string),
        TX.coerce_text(F.unhex(L("20C3A9FF20")), binary),
        TX.coerce_text(F.array(L(" a "), L(None).cast("string"), L("b")), T.ArrayType(string)),
        TX.coerce_text(F.struct(F.array(L("x"), L("y")).alias("text"), L("t").alias("title")), pair),
        TX.coerce_text(L(7), T.IntegerType()),
        TX.join_paragraphs(F.array(L(" a "), L(" "), L("b"))),
        TX.safe_len(F.array(L(1), L(2)), T.ArrayType(T.IntegerType())),
        TX.safe_len(L(None).cast("string"), string),
        TX.safe_len(L(5), T.IntegerType()),
        TX.has_min_chars(L("  abc "), string, 4),
    ) == ("", "é", "a\n\nb", "x\ny", "7", "a\nb", 2, 0, 0, False)


def test_sentences_and_chunks(spark):
    text = "One two. Three four five!  Six? Seven"
    r = one(spark, TX.sentences(L(text)), TX.chunks(L(text), 5), TX.chunks(L("a b c d e f. g"), 3), TX.chunks(L(""), 3))
    assert r.c0 == ["One two.", "Three four five!", "Six?", "Seven"]
    assert r.c1 == ["One two. Three four five!", "Six? Seven"]
    assert r.c2 == ["a b c d e f.", "g"]
    assert r.c3 == []


def test_summary_budget(spark):
    def budget(n):
        return one(spark, *TX.summary_budget(L(n)))

    assert budget(10) == (20, 10) and budget(100) == (80, 10) and budget(199) == (159, 10) and budget(200) == (200, 80)


def test_grams_follow_stop_word_removal(spark):
    r = one(spark, TX.one_and_two_grams(TX.without_stop_words(TX.words(L("The cat and the Dog ran")))), TX.one_and_two_grams(TX.words(L("x"))))
    assert r.c0 == ["cat", "dog", "ran", "cat dog", "dog ran"] and r.c1 == []


def test_boilerplate_and_credits(spark):
    r = one(
        spark, TX.drop_boilerplate(L("News.\nAll Rights Reserved 2020\nMore")), TX.is_photo_credit(L("x (ap photo/Jane) y")),
        TX.is_photo_credit(L("AP Photo/Jane")), TX.is_photo_credit(L(None).cast("string")),
    )
    assert tuple(r) == ("News.\nMore", True, False, False)


def test_urls(spark):
    assert one(
        spark, U.source_domain(L("https://WWW.Example.com:80/a?b")), U.source_domain(L(None).cast("string")), U.source_domain(L("no url")),
        U.source_domain(L("http://bad url\\")), U.without_www(L("WWW.a.b")), U.without_www(L("xwww.a")),
        U.absolute_url(L("/n/1"), L("https://h.org/x?y")), U.absolute_url(L("https://o.org/z"), L("https://h.org/x")),
    ) == ("www.example.com", None, "", "", "a.b", "xwww.a", "https://h.org/n/1", "https://o.org/z")


@pytest.mark.parametrize("sample,ok", [
    ("1-2025-08-10", True), ("12-2099-12-31", True), ("1-2024-08-10", False), ("1-2025-02-30", False), ("x-2025-08-10", False),
    ("2025-08-10", False), ("1-2025-8-10", False), ("1-2028-02-29", True), ("1-2025-08-10-2", False), (None, False),
])
def test_valid_sample(spark, sample, ok):
    assert one(spark, S.is_valid_sample(L(sample).cast("string"))).c0 is ok


def test_samples_order_by_date_then_batch(spark):
    ids = ["2-2025-08-10", "10-2025-08-10", "1-2025-08-12", "x-2025-08-13", "2025-08-14", "settings", "3-2024-12-31"]
    df = spark.createDataFrame([(i,) for i in ids], "sample string")
    assert SM.latest_sample(df).first()[0] == "1-2025-08-12"
    assert [r.sample for r in SM.latest_samples(df, 3).collect()] == ["1-2025-08-12", "10-2025-08-10", "2-2025-08-10"]
    assert {r.sample: (r.prev, r.next) for r in SM.sample_chain(df).collect()} == {
        "3-2024-12-31": (None, "2-2025-08-10"), "2-2025-08-10": ("3-2024-12-31", "10-2025-08-10"),
        "10-2025-08-10": ("2-2025-08-10", "1-2025-08-12"), "1-2025-08-12": ("10-2025-08-10", None)}
    days = spark.createDataFrame([(dt.date(2025, 8, 10),), (dt.date(2025, 8, 11),)], "date date")
    assert {(r.next_batch, r.next_sample) for r in SM.next_batch(df, days).collect()} == {(11, "11-2025-08-10"), (1, "1-2025-08-11")}
    assert SM.distinct_samples(df, "08-10").count() == 2


def test_date_spine(spark):
    assert [str(r.date) for r in SM.date_spine(spark, dt.date(2025, 8, 30), dt.date(2025, 9, 1)).collect()] == ["2025-08-30", "2025-08-31", "2025-09-01"]
    with pytest.raises(ValueError):
        SM.date_spine(spark, dt.date(2025, 9, 1), dt.date(2025, 8, 30))


def test_backfill_and_move(spark):
    df = spark.createDataFrame([("2-2025-08-10", "old"), ("1-2025-08-11", "old")], "sample string, date string")
    assert {tuple(r) for r in SM.backfill_dates(df).collect()} == {("2-2025-08-10", "2025-08-10"), ("1-2025-08-11", "2025-08-11")}
    assert SM.move_sample(df, "2-2025-08-10", "9-2025-08-09").where("sample = '9-2025-08-09'").count() == 1


def test_unwanted_and_publication(spark):
    d = L("2025-08-12").cast("date")
    assert one(
        spark, filters.has_unwanted(L("A required part of this site couldn't load. x")), filters.has_unwanted(L("a required part")),
        filters.has_unwanted(L(None).cast("string")), filters.publication_status(L("2025-08-12T10:00:00Z"), d),
        filters.publication_status(L("2025-08-11T10:00:00Z"), d), filters.publication_status(L("2025-08-12"), d),
    ) == (True, False, False, "kept", "skipped", None)


POOL = "url string, is_articles_processed boolean, in_sample string, created_at timestamp"


def test_link_pool_rules(spark):
    t = dt.datetime(2025, 8, 1)
    pool = spark.createDataFrame([("a", True, None, t), ("b", False, "s", t), ("c", None, None, t), ("d", False, "", t)], POOL)
    rows = spark.createDataFrame([(u,) for u in "abcdex"], "url string")
    assert sorted(r.url for r in links.gate(rows, pool).collect()) == ["c", "d", "e", "x"]
    new = spark.createDataFrame([("a", "s2", t), ("z", "s2", t), ("z", "s2", t)], "url string, sample string, created_at timestamp")
    grown = links.ensure_tracked(pool, new.select("url", "created_at"))
    assert grown.count() == 5 and grown.where("url = 'a'").first().is_articles_processed is True
    marked = links.mark_processed(pool, new)
    assert {(r.url, r.is_articles_processed, r.in_sample) for r in marked.where("url in ('a','z','c')").collect()} == {
        ("a", True, "s2"), ("z", True, "s2"), ("c", None, None)}
    assert marked.exceptAll(links.mark_processed(marked, new)).count() == 0  # a second run changes nothing


def test_stale_rules(spark):
    old, new = dt.datetime(2025, 8, 1), dt.datetime(2025, 8, 14)
    now = ts("2025-08-15 00:00:00")
    pool = spark.createDataFrame([("old", None, None, old), ("new", None, None, new), ("sampled", False, "s", old), ("done", True, None, old)], POOL)
    assert sorted(r.url for r in maintenance.keep_fresh(pool, "link_pool", now).collect()) == ["done", "new", "sampled"]
    art = spark.createDataFrame([(1, None, old), (2, "", old), (3, "x", old), (4, None, new)], "id int, text string, scraped_at timestamp")
    assert sorted(r.id for r in maintenance.keep_fresh(art, "articles", now).collect()) == [3, 4]
    clean = spark.createDataFrame([(1, True, old), (2, None, old), (3, True, new)], "id int, isProcessed boolean, scraped_at timestamp")
    assert sorted(r.id for r in maintenance.keep_fresh(clean, "clean_articles", now).collect()) == [2, 3]


def dup_frame(spark):
    day = lambda d: dt.datetime(2025, 8, d)
    rows = [(1, "s", "u", day(2)), (2, "s", " u ", day(1)), (3, "r", "u", day(3)), (4, "s", "v", day(1)), (5, "r", "w", day(1)), (6, "r", "w", day(1))]
    return spark.createDataFrame(rows, "article_id long, sample string, url string, created_at timestamp")


def test_dedupe_keeps_oldest_or_newest(spark):
    df = dup_frame(spark)
    ids = lambda d: sorted(r.article_id for r in d.collect())
    assert ids(dedup.dedupe(df)) == [2, 3, 4, 5]
    assert ids(dedup.dedupe(df, keep="newest")) == [1, 3, 4, 6]
    assert ids(dedup.dedupe(df, "url")) == [2, 4, 5]
    assert ids(dedup.dedupe(df, "url", "newest", sample="s")) == [1, 3, 4, 5, 6]
    assert ids(dedup.dedupe(df, "url", limit=1)) == [2, 4, 5, 6]
    once = dedup.dedupe(df, "url")
    assert ids(dedup.dedupe(once, "url")) == ids(once)
    assert dedup.dedupe_report(df, "url").first().asDict() == {"groups_found": 2, "groups_handled": 2, "kept": 2, "deleted": 3}
    assert dedup.dedupe_report(once, "url").first().asDict() == {"groups_found": 0, "groups_handled": 0, "kept": 0, "deleted": 0}
    with pytest.raises(ValueError):
        dedup.assert_unique(df, ["sample", "url"]) if dedup.uniqueness_violations(df, ["sample", "url"]).count() else None


def test_dedup_in_run_keeps_first_in_order(spark):
    rows = [("u", 1, 0, "late"), ("u", 0, 5, "first"), ("u", 0, 9, "copy"), ("v", 1, 1, "only")]
    df = spark.createDataFrame(rows, "url string, source_ord int, pos long, title string")
    assert sorted(r.title for r in dedup.dedup_in_run(df).collect()) == ["first", "only"]


def test_hours_and_weights(spark):
    now = ts("2025-08-15 00:00:00")
    r = one(
        spark, SCF.hours_since(ts("2025-08-14 00:00:00"), now), SCF.hours_since(L(None).cast("timestamp"), now),
        SCF.hours_since_text(L("2025-08-14T12:00:00Z"), now), SCF.hours_since_text(L("2025-08-14T12:00:00"), now),
        SCF.hours_since_text(L("soon"), now), SCF.recency_weight(L(84.0), 42), SCF.recency_weight(L(2.0), 0.1),
    )
    assert tuple(r)[:5] == (24.0, 72.0, 12.0, 72.0, 72.0)
    assert math.isclose(r.c5, math.exp(-2)) and math.isclose(r.c6, math.exp(-2))


def test_cluster_scores(spark):
    now = ts("2025-08-15 00:00:00")
    docs = spark.createDataFrame(
        [(1, "www.reuters.com", None, None, "World"), (2, "REUTERS.com", None, None, None), (3, None, "cnn.com", None, "sports"), (4, None, None, None, "nope")],
        "article_id long, source_domain string, source string, published_at timestamp, category string",
    )
    members = spark.createDataFrame([("c", 1), ("c", 3), ("c", 99), ("d", 4)], "cluster_id string, article_id long")
    got = {r.cluster_id: r for r in scores.cluster_scores(members, docs, now, ScoringConfig()).collect()}
    old = math.exp(-72 / 42)
    w1, w3, w4 = 0.5 * 1 + 0.3 * old + 0.2 * 0.95, 0.5 * 0.9 + 0.3 * old + 0.2 * 0.6, 0.5 * 0.7 + 0.3 * old + 0.2 * 1.0
    assert math.isclose(got["c"].sum_article_weight, w1 + w3) and math.isclose(got["c"].diversity_bonus, 0.5 * math.log(3))
    assert math.isclose(got["c"].cluster_score_today, w1 + w3 + 0.5 * math.log(3))
    assert math.isclose(got["d"].cluster_score_today, w4) and got["d"].diversity_bonus == 0.0


def test_sources_that_differ_in_www_count_as_two(spark):
    now = ts("2025-08-15 00:00:00")
    docs = spark.createDataFrame([(1, "www.cnn.com"), (2, "cnn.com")], "article_id long, source_domain string")
    docs = docs.selectExpr("*", "cast(null as string) source", "cast(null as timestamp) published_at", "'x' category")
    members = spark.createDataFrame([("c", 1), ("c", 2)], "cluster_id string, article_id long")
    assert math.isclose(scores.cluster_scores(members, docs, now, ScoringConfig()).first().diversity_bonus, 0.5 * math.log(3))


ROWS = "cluster_id string, article_id long, title string, text string, nouns array<string>, topic string, domain string"


def test_tfidf_of_three_documents(spark):
    rows = [("c", 1, None, "apple apple pear", [], None, None), ("c", 2, None, "apple plum", [], None, None), ("c", 3, None, "grape", [], None, None)]
    got = {r.term: r.score for r in labels.cluster_terms(spark.createDataFrame(rows, ROWS), k=20).collect()}
    idf = lambda df: math.log(4 / (1 + df)) + 1
    one_, two = idf(1), idf(2)
    len1 = math.sqrt((2 * two) ** 2 + one_**2 * 3)
    len2 = math.sqrt(two**2 + 2 * one_**2)
    assert math.isclose(got["apple"], (2 * two / len1 + two / len2) / 3, abs_tol=1e-8)
    assert math.isclose(got["grape"], 1 / 3, abs_tol=1e-8)
    assert set(got) == {"apple", "pear", "plum", "grape", "apple apple", "apple pear", "apple plum"}


def test_identical_texts_prune_every_term(spark):
    rows = [("c", i, "T", "same text", [], "unknown", None) for i in range(3)]
    df = spark.createDataFrame(rows, ROWS)
    assert labels.cluster_terms(df).count() == 0
    r = labels.cluster_summaries(df).first()
    assert r.topic_label == "misc" and r.top_terms == [] and r["size"] == 3 and r.sources is None


def test_cluster_label_order(spark):
    rows = [
        ("c", 2, "Second", "market falls", ["Bank", "bank", "rate"], "business", "b.com"),
        ("c", 1, "First", "market rises", ["rate", "euro"], "Unknown", "a.com"),
        ("c", 3, "", "other story", None, "business", None),
        ("d", 4, None, "lone wolf", [], None, "a.com"),
        ("d", 5, None, "quiet fox", [], None, "a.com"),
    ]
    got = {r.cluster_id: r for r in labels.cluster_summaries(spark.createDataFrame(rows, ROWS)).collect()}
    assert got["c"].topic_label == "business – bank – rate"
    assert got["c"].representative_titles == ["First", "Second"]
    assert [(s.domain, s["count"]) for s in got["c"].sources] == [("a.com", 1), ("b.com", 1)]
    assert got["c"].topic_distribution == {"business": 2}
    assert got["d"].topic_label == "fox – lone" and got["d"].sources[0]["count"] == 2


def test_vectors(spark):
    a, b = F.array(L(3.0), L(4.0)), F.array(L(4.0), L(3.0))
    r = one(spark, VX.cosine_similarity(a, b), VX.l2_normalize(a), VX.jaccard(F.array(L("A"), L(""), L("b")), F.array(L("a"))),
            VX.jaccard(F.array(L("")), L(None).cast("array<string>")))
    assert math.isclose(r.c0, 24 / 25, rel_tol=1e-6) and math.isclose(r.c1[0], 0.6, rel_tol=1e-6) and (r.c2, r.c3) == (0.5, 0.0)


def day(n):
    return dt.date(2025, 8, n)


DAYS = "thread_id string, date date, cluster_score_today double, top_entities array<string>"


def test_ema_and_novelty_over_days(spark):
    rows = [("t", day(1), 3.0, ["a", "b"]), ("t", day(2), 5.0, ["B", "c"]), ("t", day(3), 4.0, ["a"]), ("t", day(5), 2.0, ["a"])]
    df = spark.createDataFrame(rows, DAYS)
    ema = {r.date.day: r.ema for r in threads.ema_history(df).collect()}
    assert math.isclose(ema[1], 3) and math.isclose(ema[2], 4.4) and math.isclose(ema[3], 4.12) and math.isclose(ema[5], 2)
    nov = {r.date.day: r.novelty for r in threads.novelty_history(df).collect()}
    assert nov[1] == 1.0 and math.isclose(nov[2], 1 - 1 / 3) and math.isclose(nov[3], 1 - 1 / 3) and nov[5] == 1.0


def plain_history(rows, lam=0.7, days_back=7):
    """Day by day, as a dictionary of (thread, date) to segment, momentum and novelty."""
    out, last = {}, {}
    for thread, date, score, entities in sorted(rows, key=lambda r: (r[0], r[1])):
        own = {e.lower() for e in entities or [] if e}
        before = last.get(thread)
        if before and before[0] == date - timedelta(1):
            _, segment, ema, past = before
            seen = {e for d, es in past if d >= date - timedelta(days_back) for e in es}
            ema = lam * score + (1 - lam) * ema
            novelty = 1 - (len(own & seen) / len(own | seen) if own | seen else 0.0)
        else:
            segment, ema, past, novelty = date, score, [], 1.0
        last[thread] = (date, segment, ema, [*past[-days_back:], (date, own)])
        out[thread, date] = (segment, ema, novelty)
    return out


def test_histories_against_day_by_day(spark):
    rng = random.Random(8)
    rows = []
    for t in range(12):
        at = day(1) + timedelta(rng.randint(-3000, 300))
        for _ in range(rng.choice([1, 5, 90, 400])):
            names = [rng.choice(["Ann", "ann", "bo", "cy", "", None, "dee", "eve", "flo"]) for _ in range(rng.randint(0, 5))]
            rows.append((f"t{t}", at, rng.random() * 10, rng.choice([names, names, None])))
            at += timedelta(rng.choice([1] * 30 + [2, 9]))
    want = plain_history(rows)
    df = spark.createDataFrame(rows, DAYS).repartition(5)
    got = {(r.thread_id, r.date): (r.segment, r.ema) for r in threads.ema_history(df).collect()}
    assert len(got) == len(rows) and all(got[k][0] == want[k][0] and math.isclose(got[k][1], want[k][1], rel_tol=1e-9) for k in want)
    got = {(r.thread_id, r.date): (r.segment, r.novelty) for r in threads.novelty_history(df).collect()}
    assert len(got) == len(rows) and all(got[k][0] == want[k][0] and math.isclose(got[k][1], want[k][2], abs_tol=1e-12) for k in want)
    assert threads.ema_history(df.limit(0)).count() == threads.novelty_history(df.limit(0)).count() == 0
    for plan in (threads.ema_history(df), threads.novelty_history(df)):
        assert "flatten" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_one_thread_of_a_hundred_thousand_days(spark):
    first = day(1).replace(year=1740)
    df = spark.range(100_000).select(
        F.lit("t").alias("thread_id"), F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"),
        (F.col("id") % 97).cast("double").alias("cluster_score_today"), F.array((F.col("id") % 10).cast("string")).alias("top_entities"),
    )
    got = threads.ema_history(df).orderBy("date").select("ema", "segment").toPandas()
    ema, want = None, []
    for i in range(100_000):
        ema = float(i % 97) if ema is None else 0.7 * (i % 97) + (1 - 0.7) * ema
        want.append(ema)
    assert len(got) == 100_000 and set(got.segment) == {first}
    assert max(abs(a - b) for a, b in zip(got.ema, want, strict=True)) < 1e-9
    # Blocks of the one thread lie in many tasks, where Spark does not put small partitions together.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = df.withColumn("day", F.datediff("date", F.lit(first)))
        seen = scan.prefix_scan(numbered, ["thread_id"], "day", F.lit(1), "bigint", lambda x, y: x + y).withColumn("p", F.spark_partition_id())
        total = seen.agg(F.sum("scan").alias("sum"), F.countDistinct("p").alias("tasks")).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert total["sum"] == 100_000 * 100_001 // 2 and total["tasks"] > 4
    nov = threads.novelty_history(df)
    assert nov.count() == 100_000 and nov.where("novelty < 1").count() == 0  # seen again after ten days only


HISTORY = "thread_id string, centroid array<double>, ema double, top_entities array<string>, date date"
RANKED = "cluster_id string, centroid array<double>, top_entities array<string>, cluster_score_today double, diversity_bonus double"


def test_advance_threads(spark):
    history = spark.createDataFrame([
        ("t1", [1.0, 0.0], 2.0, ["x"], day(14)), ("t1", [1.0, 0.0], 1.0, ["y"], day(8)), ("t1", [1.0, 0.0], 1.0, ["z"], day(7)),
        ("t2", [0.0, 1.0], 9.0, ["q"], day(13)), ("t1", [1.0, 0.0], 7.0, ["x"], day(15)), ("t0", [], 1.0, [], day(14)),
        ("t9", [1.0, 0.0], 5.0, [], day(14)),
    ], HISTORY)
    ranked = spark.createDataFrame([
        ("a", [2.0, 0.1], ["x", "z"], 3.0, 0.5), ("b", [0.1, 2.0], ["q"], 1.0, 0.0), ("c", [3.0, 0.0], ["x"], 8.0, 0.0), ("e", [], ["x"], 1.0, 0.0)], RANKED)
    date = F.lit("2025-08-15").cast("date")
    got = {r.cluster_id: r for r in threads.advance_threads(ranked, history, date).collect()}
    assert got["a"].thread_id == "t1" and math.isclose(got["a"].ema, 0.7 * 3 + 0.3 * 2)
    assert math.isclose(got["a"].novelty, 1 - 1 / 3)  # seen: x, y; z is too old, today's own row is not read
    assert math.isclose(got["a"].trend_score, got["a"].ema + got["a"].novelty + 0.5)
    assert got["b"].thread_id == "thr-b" and got["b"].ema == 1.0 and got["b"].novelty == 1.0  # its thread skipped a day
    assert got["c"].thread_id == "t1" and got["e"].thread_id == "thr-e"
    rows = threads.advance_threads(ranked, history, date)
    stored = threads.stored_threads(rows)
    assert {(r.thread_id, r.cluster_id) for r in stored.collect()} == {("t1", "c"), ("thr-b", "b"), ("thr-e", "e")}
    again = threads.advance_threads(ranked, history.unionByName(stored.select(*history.columns)), date)
    assert again.exceptAll(rows).count() == 0
    assert threads.top_threads(rows, 1).first().cluster_id == "c"


def test_link_threshold_is_inclusive(spark):
    today = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.79, 0.6131])], "cluster_id string, centroid array<double>")
    prev = spark.createDataFrame([("t", [0.8, 0.6])], "thread_id string, centroid array<double>")
    got = {r.cluster_id for r in threads.link_threads(today, prev, TrendsConfig(link_similarity=0.80)).collect()}
    assert got == {"a", "b"}
    assert threads.link_threads(today, prev.where("false")).count() == 0


def test_sample_distributions(spark):
    df = spark.createDataFrame([("s", "a", ("P", 1.0)), ("s", "a", None), ("s", "b", ("P", 1.0))], "sample string, topic string, sentiment struct<label:string,score:double>")
    got = {(r.kind, r.label): r.percentage for r in stats.sample_distributions(df).collect()}
    assert got == {("topic", "a"): 66.67, ("topic", "b"): 33.33, ("sentiment", "P"): 66.67, ("sentiment", "unknown"): 33.33}


def test_config():
    cfg = config_from({"ema_lambda": 0.5}, {"distance": 0.2, "top_words": 5})
    assert (cfg.trends.ema_lambda, cfg.clusters.distance, cfg.top_words) == (0.5, 0.2, 5)
    assert config_from() == EngineConfig()
    with pytest.raises(KeyError):
        config_from({"nope": 1})
