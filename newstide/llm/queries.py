"""Registered queries of the corpus operators: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newstide.llm import decontam, isoforest, packing, pairrank, passes, rans, secret_scan, simhash, spectrum, treap, unigram, urlfilter, warc
from newstide.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_cost_packing(spark, sf_dir):
    """Pieces of all documents in sequences of 4096 tokens, balanced by estimated attention cost."""
    out = packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op6_trigram_secrets(spark, sf_dir):
    """Secrets of every document: counts and spans of the base rules, and all spans."""
    rows = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.BASE]
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select(
        "doc_id",
        *[count(kind) for kind in base],
        F.sha2(secret_scan.listed(F.filter("secrets", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        secret_scan.listed(F.col("secrets")).alias("spans"),
    )


@query
def op8_url_rules(spark, sf_dir):
    """Verdict on the url of every page."""
    return urlfilter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


@query
def op7_gray_simhash(spark, sf_dir):
    """Fingerprint and near-duplicate component of every document."""
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def held_out(doc_id):
    """Rows that take no part in learning: the remainder of the CRC of the id as text, divided by 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


@query
def op3_pairwise_quality(spark, sf_dir):
    """Quality of every document by a pairwise ranking model learnt from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = pairrank.fit(docs, table(spark, sf_dir, "labels"), usable=~held_out("doc_id"))
    return pairrank.score_quality(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


@query
def op10_isolation_rules(spark, sf_dir):
    """Rule statistics of every document and whether the rules and the isolation forest keep it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return isoforest.judge(docs, isoforest.fit(docs, table(spark, sf_dir, "labels"))).drop("text")


@query
def op2_bm25_decontamination(spark, sf_dir):
    """Documents that contain a benchmark item, with the share of question and answer found."""
    found = decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", *[F.round(c, 6).alias(c) for c in ("score", "question_overlap", "answer_overlap", "overlap")])


@query
def op9_rans_tokens(spark, sf_dir):
    """Ids of every document written to files and read back from them."""
    path = scratch_path(spark, "tokens")
    rans.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return rans.read_tokens(spark, path, ids_crc32=F.crc32)


@query
def op1_warc_chain(spark, sf_dir):
    """Pages written as WARC records and read back, with revisits of equal payloads."""
    path = scratch_path(spark, "warc")
    warc.write_pages(table(spark, sf_dir, "pages"), path)
    return warc.page_payloads(spark, path)


@query
def op4_unigram_counts(spark, sf_dir):
    """Tokens of every document under the unigram vocabulary, and the score of the best segmentation."""
    return unigram.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("piece_bpe_32k.model")).drop("text")


@query
def op11_treap_search(spark, sf_dir):
    """The 50 best documents for every benchmark item."""
    index = treap.build_index(table(spark, sf_dir, "documents"))
    return treap.search(index, table(spark, sf_dir, "benchmark"))


@query
def op12_spectrum_whitening(spark, sf_dir):
    """All usable vectors along the 16 leading components of their covariance, whitened."""
    rows = table(spark, sf_dir, "embeddings")
    return spectrum.whiten(rows, spectrum.fit(rows))


@query
def op13_projection_passes(spark, sf_dir):
    """Near-duplicate vectors of each label: links, component and whether the row is its first."""
    return passes.near_duplicates(table(spark, sf_dir, "embeddings"))
