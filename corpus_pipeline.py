"""Corpus pipeline: raw documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the documents of
the next one, so that a lost executor costs a stage's own work at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newstide.llm import decontam, isoforest, packing, secret_scan, simhash
from newstide.llm.queries import table, vocabulary
from newstide.session import stage as staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits and the isolation forest keep; null and empty texts fail the base limits.

    Equal texts get equal verdicts. Without usable labels nothing is rejected beyond the base limits.
    """
    model = isoforest.fit(docs, table(spark, sf_dir, "labels"))
    return isoforest.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group whose fingerprints, of shingles of 3 words, link at 3 or fewer bits.

    A null or empty text has fingerprint zero; ties and null ids as ``simhash.keep_one`` says. An empty table stays empty.
    """
    return simhash.keep_one(docs, width=3, most=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them; null and empty texts hold none. An empty benchmark drops nothing."""
    return decontam.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked; ``n_chars`` is that of the text as it now is, null for a null text."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens; a null text counts as an empty one and has its end id only."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("decontamination", decontaminate),
    ("secret scans", secret_scans),
    ("packing", pack_sequences),
]

#: Word statistics, forests, fingerprints and tokenizers have no SQL form; tests compare the run with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = staged(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
