"""The registered queries: each takes (spark, sf_dir) and returns a flat DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newstide.config import ClusterConfig, EngineConfig, TrendsConfig, UNWANTED_SNIPPETS
from newstide.functions import samples as S
from newstide.functions import text as TX
from newstide.functions import urls as U
from newstide.functions import vectors as VX
from newstide.operators import clusters as CL
from newstide.operators import dedup as DD
from newstide.operators import filters as FL
from newstide.operators import labels as LB
from newstide.operators import links as LK
from newstide.operators import maintenance as MT
from newstide.operators import models as MD
from newstide.operators import neighbours as NB
from newstide.operators import postings as PO
from newstide.operators import samples as SM
from newstide.operators import scores as SC
from newstide.operators import sketches as SK
from newstide.operators import stats as ST
from newstide.operators import threads as TH
from newstide.operators import words as W
from newstide.plans import clean as CN
from newstide.plans import gather as GA
from newstide.plans import trends as TR
from newstide.session import cut, scratch_path, stage
from newstide.sources import elements as EL
from newstide.sources import feeds as FD
from newstide.sources import maintext as MX
from newstide.sources import pages as PG
from newstide.sources import plugin as PI
from newstide.sources.tables import set_where, upsert
from newstide.streaming import intake as IN
from newstide.streaming import pool as SP
from newstide.workload import views as V

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# --- words -------------------------------------------------------------------


@query
def word_occurrences(spark, sf_dir):
    return W.word_profile(V.clean_articles(spark, sf_dir))


@query
def word_counts(spark, sf_dir):
    return W.word_counts(V.clean_articles(spark, sf_dir))


@query
def word_metrics(spark, sf_dir):
    return W.word_metrics(V.clean_articles(spark, sf_dir))


@query
def word_metrics_sketched(spark, sf_dir):
    """Words per batch over all its days, merged from the sketches of the samples; the estimate is held against the exact count.

    ``close`` says that they differ by at most four standard errors.
    """
    clean = V.clean_articles(spark, sf_dir)
    batch = S.sample_batch(F.col("sample")).alias("batch")
    stored = cut(SK.word_sketches(clean)).select(batch, "total_words", "words")
    exact = W.word_counts(clean).select(batch, "word").distinct().groupBy("batch").agg(F.count("*").alias("distinct_words"))
    close = F.abs(F.col("distinct_estimate") - F.col("distinct_words")) <= 4 * SK.ERROR * F.col("distinct_words")
    rows = SK.merge_sketches(stored, "batch").join(exact, "batch")
    return rows.select("batch", "total_words", "distinct_words", close.alias("close"))


@query
def word_context(spark, sf_dir):
    return W.word_context(W.word_profile(V.clean_articles(spark, sf_dir)))


@query
def daily_trends_words(spark, sf_dir):
    return W.daily_words(V.clean_articles(spark, sf_dir), limit=15)


# --- filters and scalar functions --------------------------------------------


@query
def candidate_filter(spark, sf_dir):
    rows = FL.candidates(V.raw_candidates(spark, sf_dir))
    return rows.select("source_ord", "pos", "url", "title", F.md5("text").alias("text_md5"))


@query
def union_sources(spark, sf_dir):
    return V.raw_candidates(spark, sf_dir).select("source_ord", "pos", "url", "title", "source", F.length("text").alias("n"))


UNWANTED_IN_DATA = UNWANTED_SNIPPETS + ["All rights reserved.", "MIT License"]


@query
def unwanted_filter(spark, sf_dir):
    rows = V.articles(spark, sf_dir).where(~FL.has_unwanted(F.col("text"), UNWANTED_IN_DATA))
    return rows.select("article_id", "sample")


@query
def published_on(spark, sf_dir):
    """Publication status of ISO times; those of one language are cut to a date and so unreadable."""
    iso = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = F.when(F.col("lang") == "fr", F.substring_index(iso, "T", 1)).otherwise(iso)
    status = FL.publication_status(text, F.lit("2025-08-12").cast("date"))
    return V.articles(spark, sf_dir).groupBy("sample", status.alias("status")).agg(F.count("*").alias("cnt"))


@query
def valid_samples(spark, sf_dir):
    return V.sample_like_ids(spark, sf_dir).select("doc_id", "sample", S.is_valid_sample(F.col("sample")).alias("is_valid"))


@query
def photo_credit(spark, sf_dir):
    """Captions made of title and source; labelled articles carry a credit."""
    credit = F.when(F.col("isCleaned"), "(AP PHOTO/").when(~F.col("isCleaned"), "(ap photo/").otherwise("(photo by ")
    caption = F.concat(F.coalesce("title", F.lit("")), credit, F.col("source"), F.lit(")"))
    return V.articles(spark, sf_dir).select("article_id", TX.is_photo_credit(caption).alias("is_credit"))


@query
def boilerplate_lines(spark, sf_dir):
    lines = F.split("text", "\n")
    return V.articles(spark, sf_dir).select(
        "article_id",
        F.size(F.filter(lines, lambda x: TX.is_boilerplate(x))).alias("dropped"),
        F.md5(TX.drop_boilerplate(F.col("text"))).alias("kept_md5"),
    )


@query
def coerce_text(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.encode(F.concat(F.lit("\n "), "text", F.lit("\t")), "UTF-8").alias("raw"),
        F.split("text", "\n").alias("lines"),
        F.struct(F.col("source").alias("title"), F.col("text").alias("text")).alias("doc"),
        F.when(F.col("lang") != "es", F.col("n_chars")).alias("size"),
    )
    types = {f.name: f.dataType for f in docs.schema}
    out = [F.md5(TX.coerce_text(F.col(c), types[c])).alias(f"{c}_md5") for c in ("raw", "lines", "doc")]
    return docs.select("doc_id", *out, TX.coerce_text(F.col("size"), types["size"]).alias("size_text"))


@query
def join_paragraphs(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    parts = F.transform(F.split("text", r"\."), lambda s: F.when(F.length(s) > 8, s))
    return docs.select("doc_id", F.md5(TX.join_paragraphs(parts)).alias("joined_md5"))


@query
def min_chars(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    maybe = F.when(F.col("lang") != "es", F.col("text"))
    string = docs.schema["text"].dataType
    return docs.select(
        "doc_id",
        TX.has_min_chars(maybe, string, 500).alias("long_enough"),
        TX.safe_len(maybe, string).alias("n"),
    )


@query
def source_domain(spark, sf_dir):
    pages = V.table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", U.source_domain(F.col("url")).alias("domain"), U.without_www(U.source_domain(F.col("url"))).alias("bare")
    )


@query
def sentences(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    parts = TX.sentences(F.col("text"))
    return docs.select("doc_id", F.size(parts).alias("n"), F.md5(F.array_join(parts, "|")).alias("parts_md5"))


@query
def chunk_text(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(TX.chunks(F.col("text"), 512)).alias("chunk_no", "chunk")).select(
        "doc_id", "chunk_no", TX.token_count(F.col("chunk")).alias("tokens"), F.md5("chunk").alias("chunk_md5")
    )


@query
def length_budget(spark, sf_dir):
    n = TX.token_count(F.col("text"))
    longest, shortest = TX.summary_budget(n)
    return V.table(spark, sf_dir, "documents").select(
        "doc_id", n.alias("tokens"), longest.alias("longest"), shortest.alias("shortest")
    )


@query
def normalize_vectors(spark, sf_dir):
    v = V.table(spark, sf_dir, "embeddings")
    scaled = F.transform("embedding", lambda x: x.cast("double") * 3)
    return v.select("vec_id", F.posexplode(VX.l2_normalize(scaled)).alias("pos", "x")).select(
        "vec_id", "pos", F.round("x", 6).alias("x")
    )


@query
def jaccard_pairs(spark, sf_dir):
    """Overlap of the words of each turn with those of the turn before it."""
    turns = V.table(spark, sf_dir, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    mine = F.split("text", " ")
    rows = turns.select("conv_id", "turn", mine.alias("a"), F.lag(mine).over(w).alias("b"))
    return rows.select("conv_id", "turn", F.round(VX.jaccard(F.col("a"), F.col("b")), 6).alias("overlap"))


# --- pages -------------------------------------------------------------------


@query
def harvest_links(spark, sf_dir):
    return PG.harvest_links(V.table(spark, sf_dir, "pages"))


def _pages_with_cards(spark, sf_dir):
    """The pages, with a headline and a teaser inside each link whose address starts with a small letter."""
    card = (
        "<a class=\"card big\" data-link-type='article' href=\"$1\"><img alt=\"a > b\"><div><h2>$2</h2><br>"
        "<span data-editable=headline>$2 (teaser)</span><p>more</div></a>"
    )
    html = F.regexp_replace("html", r'<a href="(/[a-z][^"]*)">([^<]*)</a>', card)
    return V.table(spark, sf_dir, "pages").withColumn("html", html)


@query
def harvest_inner_links(spark, sf_dir):
    """``a[href^='/t'] h2``: every headline inside a link of that address."""
    return EL.select_links(_pages_with_cards(spark, sf_dir), EL.attr("href").startswith("/t"), F.col("tag") == "h2", first=False)


@query
def harvest_attribute_links(spark, sf_dir):
    """``a[data-link-type='article']``, titled by its first ``.headline`` or ``[data-editable='headline']``."""
    title = EL.has_class("headline") | (EL.attr("data-editable") == "headline")
    return EL.select_links(_pages_with_cards(spark, sf_dir), EL.attr("data-link-type") == "article", title)


@query
def extract_article_text(spark, sf_dir):
    rows = PG.extract_article_text(V.table(spark, sf_dir, "pages"))
    return rows.select("page_id", F.length("text").alias("n"), F.md5("text").alias("text_md5"))


@query
def extract_main_text(spark, sf_dir):
    """The pages without their article marks: the run of blocks with the most text beside links."""
    pages = V.table(spark, sf_dir, "pages").withColumn("html", F.regexp_replace("html", "</?article>", ""))
    return MX.main_text(pages).select("page_id", F.length("text").alias("n"), F.md5("text").alias("text_md5"))


# --- samples -----------------------------------------------------------------


@query
def scan_sample(spark, sf_dir):
    return V.articles(spark, sf_dir).where(F.col("sample") == "1-2025-08-12").select("article_id", "url", "topic")


@query
def find_one_sorted(spark, sf_dir):
    """The newest article of every sample, found without sorting the sample."""
    newest = F.max_by(F.struct("article_id", "url"), F.struct("created_at", "article_id")).alias("a")
    return V.articles(spark, sf_dir).groupBy("sample").agg(newest).select("sample", "a.article_id", "a.url")


@query
def distinct_samples(spark, sf_dir):
    return SM.distinct_samples(V.articles(spark, sf_dir), "2025-08-12")


@query
def next_batch(spark, sf_dir):
    rows = SM.next_batch(V.metadata(spark, sf_dir), V.dates_of_samples(spark, sf_dir))
    return rows.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query
def latest_sample(spark, sf_dir):
    return SM.latest_sample(V.metadata(spark, sf_dir))


@query
def latest_samples(spark, sf_dir):
    rows = SM.latest_samples(V.metadata(spark, sf_dir), 5)
    return rows.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query
def sample_chain(spark, sf_dir):
    return SM.sample_chain(V.metadata(spark, sf_dir))


@query
def date_spine(spark, sf_dir):
    """Articles per publication day over the whole range of days, 0 on empty days."""
    rows = V.articles(spark, sf_dir).groupBy(F.to_date("published_at").alias("date")).agg(F.count("*").alias("cnt"))
    start, end = rows.agg(F.min("date"), F.max("date")).first()
    days = SM.date_spine(spark, start, end)
    return days.join(rows, "date", "left").select(
        F.date_format("date", "yyyy-MM-dd").alias("date"), F.coalesce("cnt", F.lit(0)).alias("cnt")
    )


@query
def backfill_dates(spark, sf_dir):
    rows = SM.backfill_dates(V.articles(spark, sf_dir))
    return rows.groupBy("sample", "date").agg(F.count("*").alias("cnt"))


@query
def move_sample(spark, sf_dir):
    rows = SM.move_sample(V.articles(spark, sf_dir), "2-2025-08-11", "2-2025-08-10")
    return rows.groupBy("sample").agg(F.count("*").alias("cnt"))


# --- counts ------------------------------------------------------------------


@query
def sample_distributions(spark, sf_dir):
    return ST.sample_distributions(V.articles(spark, sf_dir))


@query
def outcome_counts(spark, sf_dir):
    """Copies of a url and urls of the pool are skipped, articles without any label fail."""
    rows = GA.admit(V.articles(spark, sf_dir), V.link_pool(spark, sf_dir), order=("article_id",))
    status = F.when(F.col("status") == "skipped", "skipped").when(F.col("lang") == "es", "failed").otherwise("ok")
    return ST.outcome_counts(rows.withColumn("status", status))


@query
def per_sample_counts(spark, sf_dir):
    clean = V.clean_articles(spark, sf_dir).where("isCleaned")
    return ST.per_sample_counts(V.metadata(spark, sf_dir), V.articles(spark, sf_dir), clean)


@query
def backlog_counts(spark, sf_dir):
    rows = V.articles(spark, sf_dir)
    return ST.backlog_counts(rows, rows.where("isCleaned or lang = 'fr'"))


@query
def top_sources(spark, sf_dir):
    return ST.top_sources(V.articles(spark, sf_dir), 10)


# --- links, duplicates and upkeep ---------------------------------------------


@query
def link_pool_gate(spark, sf_dir):
    rows = LK.gate(V.articles(spark, sf_dir), V.link_pool(spark, sf_dir))
    return rows.select("article_id", "url")


@query
def ensure_tracked(spark, sf_dir):
    pool = LK.ensure_tracked(V.link_pool(spark, sf_dir), V.articles(spark, sf_dir).select("url", "created_at"))
    return _pool_rows(pool)


@query
def mark_processed(spark, sf_dir):
    done = V.articles(spark, sf_dir).where("lang = 'fr'").select("url", "sample", "created_at")
    return _pool_rows(LK.mark_processed(V.link_pool(spark, sf_dir), done))


def _pool_rows(pool):
    return pool.select("url", "is_articles_processed", "in_sample", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


@query
def dedup_in_run(spark, sf_dir):
    rows = DD.dedup_in_run(FL.candidates(V.raw_candidates(spark, sf_dir)))
    return rows.select("url", "source_ord", "pos", "title")


@query
def duplicate_groups(spark, sf_dir):
    return DD.duplicate_groups(V.articles(spark, sf_dir), "sample_url")


@query
def duplicate_groups_first(spark, sf_dir):
    """The first ten groups by url, as a limited run handles them."""
    return DD.duplicate_groups(V.articles(spark, sf_dir), "url", limit=10)


@query
def dedupe_keep(spark, sf_dir):
    return DD.dedupe(V.articles(spark, sf_dir), "url", "newest").select("article_id", "sample", "url")


@query
def dedupe_report(spark, sf_dir):
    return DD.dedupe_report(V.articles(spark, sf_dir), "url", limit=5)


@query
def uniqueness_violations(spark, sf_dir):
    return DD.uniqueness_violations(V.articles(spark, sf_dir), ["sample", "url"])


@query
def prune_stale(spark, sf_dir):
    rows = V.articles(spark, sf_dir).withColumn("text", F.when(F.col("lang") != "es", F.col("text")))
    return MT.prune_counts(V.link_pool(spark, sf_dir), rows, rows, V.as_of(), days=3)


@query
def prune_stale_pool(spark, sf_dir):
    return _pool_rows(MT.keep_fresh(V.link_pool(spark, sf_dir), "link_pool", V.as_of(), days=3))


# --- scores ------------------------------------------------------------------


@query
def article_weights(spark, sf_dir):
    rows = SC.article_weights(V.clean_articles(spark, sf_dir), V.as_of(), V.TEST_SCORING)
    return rows.select(
        "article_id", *[F.round(c, 6).alias(c) for c in ("source_weight", "recency_weight", "category_weight", "article_weight")]
    )


@query
def cluster_scores(spark, sf_dir):
    rows = V.grouped_articles(spark, sf_dir)
    out = SC.cluster_scores(rows, V.clean_articles(spark, sf_dir), V.as_of(), V.TEST_SCORING)
    cols = ("sum_article_weight", "diversity_bonus", "cluster_score_today")
    return out.select("cluster_id", *[F.round(c, 6).alias(c) for c in cols])


@query
def clusters_by_score(spark, sf_dir):
    """The five best-scored clusters in their order."""
    rows = V.grouped_articles(spark, sf_dir)
    scored = SC.cluster_scores(rows, V.clean_articles(spark, sf_dir), V.as_of(), V.TEST_SCORING)
    top = SC.by_score(scored.withColumn("cluster_score_today", F.round("cluster_score_today", 6))).limit(5).withColumn("_at", F.monotonically_increasing_id())
    return top.select(F.row_number().over(Window.orderBy("_at")).alias("rank"), "cluster_id", "cluster_score_today")


@query
def clusters_by_size(spark, sf_dir):
    """The five largest clusters in their order."""
    sizes = V.grouped_articles(spark, sf_dir).groupBy("cluster_id").agg(F.count("*").alias("size"))
    top = SC.by_size(sizes).limit(5).withColumn("_at", F.monotonically_increasing_id())
    return top.select(F.row_number().over(Window.orderBy("_at")).alias("rank"), "cluster_id", "size")


# --- labels ------------------------------------------------------------------


@query
def cluster_terms(spark, sf_dir):
    return LB.cluster_terms(V.cluster_rows(spark, sf_dir)).withColumn("score", F.round("score", 6))


@query
def cluster_entities(spark, sf_dir):
    return LB.cluster_entities(V.cluster_rows(spark, sf_dir))


@query
def cluster_labels(spark, sf_dir):
    return LB.cluster_summaries(V.cluster_rows(spark, sf_dir)).select("cluster_id", "topic_label")


@query
def cluster_summary(spark, sf_dir):
    """Size, first titles, domains and topics of each cluster, one row per element."""
    rows = V.cluster_rows(spark, sf_dir)
    null = F.lit(None).cast("string")
    size = LB.cluster_sizes(rows).select("cluster_id", F.lit("size").alias("kind"), null.alias("value"), F.col("size").alias("n"))
    title = LB.cluster_titles(rows).select("cluster_id", F.lit("title").alias("kind"), F.md5("title").alias("value"), F.col("rank").cast("long").alias("n"))
    domain = LB.cluster_domains(rows).select("cluster_id", F.lit("domain").alias("kind"), F.col("domain").alias("value"), F.col("cnt").alias("n"))
    topic = LB.cluster_topics(rows).select("cluster_id", F.lit("topic").alias("kind"), F.col("topic").alias("value"), F.col("cnt").alias("n"))
    return size.unionByName(title).unionByName(domain).unionByName(topic)


# --- vectors -----------------------------------------------------------------

TEST_DISTANCE = 0.60  # the given vectors lie at least 0.40 apart


@query
def cluster_centroids(spark, sf_dir):
    rows = V.table(spark, sf_dir, "embeddings").select(F.col("label").alias("cluster_id"), F.col("embedding").alias("vec"))
    return CL.centroids(rows).select("cluster_id", F.posexplode("centroid").alias("pos", "x")).withColumn("x", F.round("x", 6))


@query
def similar_vectors(spark, sf_dir):
    """For each vector the number of others within the distance, and the nearest."""
    rows = NB.nearest(V.vectors(spark, sf_dir), None, TEST_DISTANCE)
    return rows.select(F.col("id").alias("vec_id"), "n_within", F.col("other").alias("nearest_id"), F.round("dist", 6).alias("dist"))


@query
def cluster_components(spark, sf_dir):
    rows = CL.vector_components(V.vectors(spark, sf_dir), TEST_DISTANCE)
    return rows.select(F.col("id").alias("vec_id"), "component")


@query
def cluster_vectors(spark, sf_dir):
    rows = CL.cluster_vectors(V.vectors(spark, sf_dir), ClusterConfig(distance=TEST_DISTANCE))
    return rows.select(F.col("id").alias("vec_id"), "cluster", "size", "ordinal")


@query
def resolve_vectors(spark, sf_dir):
    """Labels as samples; those with a missing vector are computed anew, here as the vector reversed."""
    rows = V.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("article_id"), F.col("label").cast("string").alias("sample"), F.col("embedding").alias("raw"),
        F.when((F.get("embedding", F.lit(0)) <= 0.2) | (F.col("label") >= 5), F.col("embedding")).alias("embedding"),
    )
    out = MD.resolve_vectors(rows, lambda df: df.select("article_id", VX.l2_normalize(F.reverse("raw")).alias("vec")))
    return out.select("article_id", "sample", "reuse", F.posexplode("vec").alias("pos", "x")).withColumn("x", F.round(F.col("x").cast("double"), 6))


@query
def embed_text(spark, sf_dir):
    rows = V.clean_articles(spark, sf_dir)
    out = MD.embed_text(rows, MD.fit_idf(rows))
    return out.select("article_id", F.round(VX.norm(F.col("vec.values")), 6).alias("length"))


def _portable_vectors(rows):
    """Vectors of texts whose slots other engines can work out."""
    return MD.embed_text(rows, MD.fit_idf(rows, hashed=MD.portable_hash), hashed=MD.portable_hash)


@query
def embed_slots(spark, sf_dir):
    """Per text the number of slots, the greatest value with its slot, and the sum of the values."""
    cells = _portable_vectors(V.clean_articles(spark, sf_dir)).select("article_id", F.explode(F.arrays_zip("vec.indices", "vec.values")).alias("c"))
    return cells.groupBy("article_id").agg(
        F.count("*").alias("slots"), F.round(F.max("c.values"), 6).alias("top"),
        F.sum(F.col("c.indices").cast("long")).alias("slot_sum"), F.round(F.sum("c.values"), 6).alias("total"),
    )


@query
def similar_texts(spark, sf_dir):
    """For each text with a text at a cosine above 0.7 the nearest one and its component, through shared rare slots."""
    rows = stage(_portable_vectors(V.clean_articles(spark, sf_dir)).select(F.lit("all").alias("grp"), F.col("article_id").alias("id"), "vec"), compression="zstd")
    near = PO.best_matches(rows, None, ClusterConfig().distance)
    component = CL.vector_components(rows, ClusterConfig().distance)
    return near.join(component, ["grp", "id"]).select(
        F.col("id").alias("article_id"), F.col("other").alias("nearest_id"), F.round("dist", 6).alias("dist"), "component"
    )


# --- threads -----------------------------------------------------------------


@query
def link_threads(spark, sf_dir):
    """Every vector is a cluster of today, the mean of every label a thread of yesterday."""
    rows = V.table(spark, sf_dir, "embeddings")
    today = rows.select(F.concat(F.lit("c"), F.col("vec_id").cast("string")).alias("cluster_id"), F.col("embedding").alias("centroid"))
    threads = CL.centroids(rows.select(F.concat(F.lit("t"), F.col("label").cast("string")).alias("cluster_id"), F.col("embedding").alias("vec")), unit=True)
    linked = TH.link_threads(today, threads.withColumnRenamed("cluster_id", "thread_id"), TrendsConfig(link_similarity=0.30))
    return today.select("cluster_id").join(linked, "cluster_id", "left").select("cluster_id", "thread_id", F.round("similarity", 6).alias("similarity"))


@query
def link_text_threads(spark, sf_dir):
    """Every text is a cluster of today, the texts of the second batch are yesterday's threads; sparse vectors."""
    rows = V.clean_articles(spark, sf_dir)
    vectors = stage(_portable_vectors(rows).join(rows.select("article_id", "batch"), "article_id"), compression="zstd")
    today = vectors.select(F.concat(F.lit("c"), F.col("article_id").cast("string")).alias("cluster_id"), F.col("vec").alias("centroid"))
    yesterday = vectors.where("batch = 2").select(F.concat(F.lit("t"), F.col("article_id").cast("string")).alias("thread_id"), F.col("vec").alias("centroid"))
    return TH.link_threads(today, yesterday).select("cluster_id", "thread_id", F.round("similarity", 6).alias("similarity"))


def _day_text(df):
    for c in ("date", "segment"):
        if c in df.columns:
            df = df.withColumn(c, F.date_format(c, "yyyy-MM-dd"))
    return df


@query
def thread_ema(spark, sf_dir):
    return _day_text(TH.ema_history(V.thread_days(spark, sf_dir))).withColumn("ema", F.round("ema", 6))


@query
def thread_novelty(spark, sf_dir):
    return _day_text(TH.novelty_history(V.thread_days(spark, sf_dir))).withColumn("novelty", F.round("novelty", 6))


@query
def top_threads(spark, sf_dir):
    days = cut(V.thread_days(spark, sf_dir))
    on = ["thread_id", "segment", "date"]
    rows = TH.ema_history(days).join(TH.novelty_history(days), on)
    scored = rows.withColumn("trend_score", F.round(F.col("ema") + F.col("novelty"), 6)).withColumn("cluster_id", F.concat_ws("/", "thread_id", "date"))
    return TH.top_threads(scored, 10).select("cluster_id", "trend_score")


@query
def upsert_threads(spark, sf_dir):
    """A week of thread days is written again with doubled scores, and one new thread per type added."""
    days = V.thread_days(spark, sf_dir).select("date", "thread_id", "cluster_score_today")
    late = days.where("date >= date'2024-01-24'")
    again = late.withColumn("cluster_score_today", F.col("cluster_score_today") * 2)
    new = late.groupBy("date", F.substring_index("thread_id", "/", 1).alias("thread_id")).agg(F.sum("cluster_score_today").alias("cluster_score_today"))
    out = upsert(days, again.unionByName(new), ["date", "thread_id"])
    return _day_text(out).withColumn("cluster_score_today", F.round("cluster_score_today", 6))


@query
def mark_rows(spark, sf_dir):
    """Articles whose text went to the clean table get their flag set; others keep theirs."""
    rows = V.articles(spark, sf_dir)
    done = V.clean_articles(spark, sf_dir).where("lang = 'en'").select("article_id")
    return set_where(rows, done, ["article_id"], isCleaned=True).select("article_id", "isCleaned")


# --- text models -------------------------------------------------------------


@query
def extract_terms(spark, sf_dir):
    rows = MD.extract_terms(V.articles(spark, sf_dir))
    return rows.select("article_id", F.size("nouns").alias("n"), F.md5(F.array_join("nouns", " ")).alias("nouns_md5"))


@query
def extract_terms_lexicon(spark, sf_dir):
    """Terms found in a lexicon, here the benchmark words with their first two thirds as lemma."""
    words = V.topic_words(spark, sf_dir).select("word").distinct()
    size = (F.length("word") * 2 / 3).cast("int")
    lexicon = words.select("word", F.substring("word", F.lit(1), size).alias("lemma"), F.when(F.length("word") > 3, "NOUN").otherwise("DET").alias("pos"))
    rows = MD.extract_terms(V.articles(spark, sf_dir), lexicon)
    return rows.select("article_id", F.size("nouns").alias("n"), F.md5(F.array_join("nouns", " ")).alias("nouns_md5"))


@query
def classify_topic(spark, sf_dir):
    rows = MD.classify_topic(V.clean_articles(spark, sf_dir), V.topic_words(spark, sf_dir))
    return rows.select("article_id", "topic")


@query
def classify_sentiment(spark, sf_dir):
    rows = MD.classify_sentiment(V.clean_articles(spark, sf_dir), V.polarity_words(spark, sf_dir))
    return rows.select("article_id", F.col("sentiment.label").alias("label"), F.round("sentiment.score", 6).alias("score"))


@query
def choose_summary(spark, sf_dir):
    """Stored summaries are the titles of one language; only texts that need a summary differ from both inputs."""
    stored = V.articles(spark, sf_dir).withColumn("stored", F.when(F.col("lang") == "fr", F.col("title")))
    rows = MD.choose_summary(stored.withColumn("summary", F.col("stored")))
    kind = F.when(F.col("summary") == F.col("stored"), "stored").when(F.length("summary") <= F.length("text"), "text or summary")
    same = F.col("summary") == F.col("text")
    taken = F.col("stored").isNotNull() | (F.length("text") <= 200)  # made summaries are compared in ``summarize``
    return rows.select("article_id", kind.alias("kind"), F.when(taken, F.md5("summary")).alias("summary_md5"), F.when(F.length("text") <= 200, same).alias("short_kept"))


@query
def summarize(spark, sf_dir):
    rows = MD.summarize(V.articles(spark, sf_dir))
    return rows.select("article_id", TX.token_count(F.col("summary")).alias("tokens"), F.md5("summary").alias("summary_md5"))


@query
def classify(spark, sf_dir):
    rows = MD.classify(V.articles(spark, sf_dir), V.topic_words(spark, sf_dir), V.polarity_words(spark, sf_dir))
    return rows.select("article_id", "topic", F.col("sentiment.label").alias("label"), "status", F.md5("summary").alias("summary_md5"))


# --- landed feeds and streams ---------------------------------------------------


def _landed_feed(spark, sf_dir):
    """The articles as feed result pages, one folder per category, in the shared folder."""
    iso = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    entry = F.struct("title", "url", F.col("text").alias("content"), iso.alias("publishedAt"), F.struct(F.col("source").alias("name")).alias("source"))
    path = scratch_path(spark, "feed")
    rows = V.articles(spark, sf_dir).select(F.coalesce("category", F.lit("none")).alias("category"), F.array(entry).alias("articles"))
    rows.write.partitionBy("category").json(path)
    return path


def _feed_bodies(spark, sf_dir):
    """A body for every url."""
    rows = V.articles(spark, sf_dir)
    return rows.groupBy("url").agg(F.min_by("text", "article_id").alias("text"))


def _feed_rows(df, *more):
    return df.select("url", "title", "source", F.md5("text").alias("text_md5"), *more).groupBy("url", "title", "source", "text_md5", *more).agg(F.count("*").alias("cnt"))


@query
def ingest_feed_json(spark, sf_dir):
    feed = FD.read_feed_json(spark, _landed_feed(spark, sf_dir))
    return _feed_rows(FD.topical_feed(feed, _feed_bodies(spark, sf_dir), V.as_of()))


@query
def ingest_mixed_json(spark, sf_dir):
    """The articles as feed pages whose titles, contents and sources change type from entry to entry."""
    rows = V.articles(spark, sf_dir)
    lines, kind = F.split("text", "\n"), F.col("article_id") % 5

    def page(title, content, source):
        return F.to_json(F.struct(F.array(F.struct(title.alias("title"), "url", content.alias("content"), source.alias("source"))).alias("articles")))

    title, text, source = F.col("title"), F.col("text"), F.col("source")
    value = (
        F.when(kind == 0, page(title, text, source))
        .when(kind == 1, page(F.col("article_id"), lines, F.struct(source.alias("name"))))
        .when(kind == 2, page(title, F.struct(text.alias("text"), title.alias("title")), source))
        .when(kind == 3, page(F.array(title, title), F.struct(lines.alias("text")), F.struct(source.alias("name"))))
        .otherwise(page(title, F.array(F.struct(lines.alias("text"))), source))
    )
    path = scratch_path(spark, "mixed-feed")
    rows.select(value.alias("value")).write.text(path)
    feed = FD.read_feed_variant(spark, path).select("title", "url", F.col("content").alias("text"), F.col("source.name").alias("source"))
    return _feed_rows(feed)


@query
def ingest_category_json(spark, sf_dir):
    feed = FD.read_feed_json(spark, _landed_feed(spark, sf_dir)).where(F.col("category") != "none")
    rows = FD.category_feed(feed, _feed_bodies(spark, sf_dir), V.as_of(), F.lit("2025-08-12").cast("date"))
    return _feed_rows(rows, "category", "published_at")


@query
def ingest_rss_xml(spark, sf_dir):
    path = scratch_path(spark, "rss")
    entry = V.articles(spark, sf_dir).select("title", F.col("url").alias("link"), F.col("source").alias("description"))
    entry.write.format("xml").option("rowTag", "item").option("rootTag", "channel").save(path)
    rows = FD.rss_with_summaries(FD.read_rss(spark, path), "wire", V.as_of())
    return _feed_rows(rows)


@query
def stream_intake(spark, sf_dir):
    """The documents read as a stream of files and landed once, counted by source and language."""
    batch = V.table(spark, sf_dir, "documents")
    stream = IN.table_stream(spark, f"{sf_dir.rstrip('/')}/documents*.parquet", batch.schema)
    out = scratch_path(spark, "intake")
    IN.run_available(stream.select("doc_id", "source", "lang", F.length("text").alias("n")), out, scratch_path(spark, "intake-state"))
    landed = spark.read.schema("doc_id long, source string, lang string, n int").parquet(out)
    return landed.groupBy("source", "lang").agg(F.count("*").alias("cnt"), F.sum("n").alias("chars"))


@query
def stream_url_dedup(spark, sf_dir):
    """Pages whose host was not seen before, found by the stream's dedup state."""
    pages = V.table(spark, sf_dir, "pages")
    stream = IN.table_stream(spark, f"{sf_dir.rstrip('/')}/pages*.parquet", pages.schema)
    host = U.source_domain(F.col("url"))
    rows = stream.select(host.alias("url"), F.lit("t").alias("title"), F.col("html").alias("text"), F.lit("2025-08-10 00:00:00").cast("timestamp").alias("scraped_at"))
    out = scratch_path(spark, "hosts")
    IN.run_available(IN.first_seen(rows).select("url"), out, scratch_path(spark, "hosts-state"))
    return spark.read.schema("url string").parquet(out)


@query
def stream_link_pool(spark, sf_dir):
    """Events as links of their user, met over weeks; purchases mark the user as processed. The stream is stopped and restarted once."""
    rows = V.table(spark, sf_dir, "events").select(F.concat(F.lit("u"), "user_id").alias("url"), F.col("ts").alias("seen_at"), (F.col("event_type") == "purchase").alias("done"))
    path, out, state = (scratch_path(spark, n) for n in ("links", "links-through", "links-state"))
    half = F.lit("2024-01-16").cast("timestamp")
    for part in (F.col("seen_at") < half, F.col("seen_at") >= half):
        rows.where(part).write.mode("append").parquet(path)
        stream = IN.table_stream(spark, path, rows.schema)
        with SP.rocks_state(spark):
            IN.run_available(SP.through_pool(stream, "seen_at", F.col("done")).select("url", "at"), out, state)
    return spark.read.schema("url string, at timestamp").parquet(out).select("url", F.unix_micros("at").alias("at_us"))


@query
def ingest_plugged_source(spark, sf_dir):
    """The articles as landed files, read by a plugged-in generator."""
    PI.register(spark)
    path = scratch_path(spark, "plugged")
    entry = V.articles(spark, sf_dir).select("url", "title", "text", "source")
    entry.write.json(path)
    return _feed_rows(spark.read.format("newstide_files").option("path", path).load())


@query
def stream_plugged_source(spark, sf_dir):
    """The same files as a stream of the source, with one restart between two landings."""
    PI.register(spark)
    path, out, state = (scratch_path(spark, n) for n in ("plugged", "plugged-landed", "plugged-state"))
    entry = V.articles(spark, sf_dir).select("url", "title", "text", "source", "lang")
    for part in (F.col("lang") == "en", F.coalesce(F.col("lang") != "en", F.lit(True))):
        entry.where(part).drop("lang").write.mode("append").json(path)
        IN.run_available(spark.readStream.format("newstide_files").option("path", path).load(), out, state)
    return _feed_rows(spark.read.schema(PI.SCHEMA).parquet(out))


# --- whole runs ----------------------------------------------------------------


@query
def gather_and_classify(spark, sf_dir):
    out = GA.gather(
        V.raw_candidates(spark, sf_dir).drop("sample"), V.link_pool(spark, sf_dir), "3-2025-08-14", V.as_of(),
        V.polarity_words(spark, sf_dir), V.topic_words(spark, sf_dir),
    )
    return out.articles.select("article_id", "url", "title", "topic", F.col("sentiment.label").alias("label"), F.md5("summary").alias("summary_md5"))


@query
def clean_articles(spark, sf_dir):
    rows = V.articles(spark, sf_dir).withColumn("summary", F.lit(None).cast("string"))
    out = CN.clean(rows, MD.fit_idf(rows))
    return out.select(
        "article_id", "sample", "source_domain", F.size("nouns").alias("nouns"), F.size("embedding.indices").alias("slots"), F.md5("summary").alias("summary_md5")
    )


@query
def trend_threads(spark, sf_dir):
    """Each batch of a day is followed from the first: batch 1 founds threads, batch 2 a day later continues them."""
    rows = V.clean_articles(spark, sf_dir)
    vec = cut(MD.embed_text(rows, MD.fit_idf(rows)))
    vec = vec.join(rows.select("article_id", "sample", "batch"), "article_id")
    cfg = EngineConfig(scoring=V.TEST_SCORING, clusters=ClusterConfig(block_rows=400))
    none = spark.createDataFrame([], TR.SPARSE_HISTORY)
    days = [F.lit(d).cast("date") for d in ("2025-08-14", "2025-08-15")]
    first = cut(TR.trend_threads(rows, vec.where("batch = 1").drop("batch"), none, days[0], V.as_of(), cfg))
    second = TR.trend_threads(rows, vec.where("batch = 2").drop("batch"), TH.stored_threads(first), days[1], V.as_of(), cfg)
    cols = ["cluster_id", "thread_id", "size", "topic_label", F.round("ema", 6).alias("ema"), F.round("novelty", 6).alias("novelty"), F.round("trend_score", 6).alias("trend_score")]
    return first.select(F.lit(1).alias("day"), *cols).unionByName(second.select(F.lit(2).alias("day"), *cols))
