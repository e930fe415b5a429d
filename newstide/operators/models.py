"""Text operators that a model may take over: terms, summary, topic, sentiment, vector.

Every default is deterministic and native or nearly so, and an honest stand-in for
a trained model. ``Models`` injects real ones; each factory runs once per Python task.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newstide.config import SENTENCE_BREAK_PATTERN, WHITESPACE
from newstide.functions import text as tx
from newstide.functions.vectors import EPS, l2_normalize
from newstide.session import bounded_batches, broadcast_if_small, cut, stage

Summariser = Callable[[str, int, int], str]  # (text, longest, shortest) -> summary


@dataclass(frozen=True)
class Models:
    """Factories of models; None keeps the default."""

    summariser: Callable[[], Summariser] | None = None
    tokens: Callable[[], Callable[[str], int]] | None = None
    topic: Callable[[], Callable[[str], dict]] | None = None  # {"labels": [...], "scores": [...]}
    sentiment: Callable[[], Callable[[str], dict]] | None = None  # {"label": ..., "score": ...}
    embedder: Callable[[], Callable[[list[str]], Any]] | None = None  # rows of floats
    tagger: Callable[[], Callable[[str], list[str]]] | None = None  # text -> nouns


# --- summaries ---------------------------------------------------------------


def leading_sentences(text: str, longest: int, shortest: int) -> str:
    """A summariser to inject: whole sentences from the start while they fit, else the first words."""
    out: list[str] = []
    room = longest
    for sentence in re.split(SENTENCE_BREAK_PATTERN, text):
        size = len(sentence.split())
        if size > room:
            break
        out.append(sentence)
        room -= size
    return " ".join(out) if out else " ".join(text.split()[:longest])


#: Words of a stretch of text that has no sentence ends; such stretches are taken in windows.
WINDOW_WORDS = 40


def _stretches(text: str, longest: int) -> list[str]:
    """Sentences; one of more than ``longest`` words in windows of at most that many."""
    out = []
    for sentence in re.split(SENTENCE_BREAK_PATTERN, text):
        words = sentence.split()
        out += [sentence] if len(words) <= longest else [" ".join(words[i : i + longest]) for i in range(0, len(words), longest)]
    return out


def salient_sentences(text: str, longest: int, shortest: int) -> str:
    """Default summariser: the sentences whose words are the commonest of the text, as many as fit, in their order.

    Every sentence of the text can win; ties go to the earlier one, and a sentence that comes again counts once.
    """
    parts = _stretches(text, min(longest, WINDOW_WORDS))
    words = [p.lower().split() for p in parts]
    counts = Counter(w for ws in words for w in ws)
    rank = sorted(range(len(parts)), key=lambda i: (-sum(counts[w] for w in words[i]) / max(1, len(words[i])), i))
    chosen, room, seen = [], longest, set()
    for i in rank:
        if 0 < len(words[i]) <= room and tuple(words[i]) not in seen:
            chosen.append(i)
            seen.add(tuple(words[i]))
            room -= len(words[i])
    return " ".join(parts[i] for i in sorted(chosen))


def _chunks(text: str, count: Callable[[str], int], max_tokens: int) -> list[str]:
    """The greedy packing of ``functions.text.chunks`` for any tokenizer."""
    packs: list[list[str]] = [[]]
    used = 0
    for sentence in re.split(SENTENCE_BREAK_PATTERN, text):
        size = count(sentence)
        if used + size > max_tokens and packs[-1]:
            packs.append([])
            used = 0
        packs[-1].append(sentence)
        used += size
    return [p for p in (" ".join(pack).strip(WHITESPACE) for pack in packs) if p]


def summarize_text(text: str | None, summarise: Summariser, count: Callable[[str], int], max_tokens: int = 512) -> str:
    """Summary of the whole text: each chunk is summarised, and again while the result is too long."""
    body = (text or "").strip(WHITESPACE)
    while len(body) >= 200:
        parts = []
        for chunk in _chunks(". ".join(_stretches(body, max_tokens)) if _overlong(body, max_tokens) else body, count, max_tokens):
            n = count(chunk)
            longest = max(int(n * 0.8), 20) if n < 200 else 200
            shortest = min(10, longest // 2) if n < 200 else 80
            try:
                parts.append(summarise(chunk, longest, shortest))
            except Exception:  # a failing chunk is left out
                continue
        shorter = "\n".join(parts)
        if count(shorter) <= max_tokens or len(shorter) >= len(body):
            return shorter
        body = shorter
    return body


def _overlong(text: str, max_tokens: int) -> bool:
    return any(len(s.split()) > max_tokens for s in re.split(SENTENCE_BREAK_PATTERN, text))


def _word_count(text: str) -> int:
    return len(text.split())


def summarize(df: DataFrame, column: str = "text", out: str = "summary", models: Models = Models()) -> DataFrame:
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        make = models.summariser() if models.summariser else salient_sentences  # once per task
        count = models.tokens() if models.tokens else _word_count
        for texts in batches:
            yield texts.map(lambda t: summarize_text(t, make, count))

    bounded_batches(df.sparkSession)
    return df.withColumn(out, run(F.col(column)))


def choose_summary(df: DataFrame, models: Models = Models()) -> DataFrame:
    """Stored summary, else a text of at most 200 characters, else its summary; only the last go to Python."""
    text = tx.strip(F.col("text"))
    ready = F.coalesce(tx.blank_to_null(F.col("summary")), F.when(F.length(text) <= 200, text))
    marked = df.withColumn("_ready", ready)
    done = marked.where("_ready is not null").withColumn("summary", F.col("_ready"))
    todo = summarize(marked.where("_ready is null"), "text", "summary", models)
    return done.unionByName(todo).drop("_ready")


# --- terms -------------------------------------------------------------------


def extract_terms(
    df: DataFrame, lexicon: DataFrame | None = None, stop_words: list[str] | None = None, models: Models = Models()
) -> DataFrame:
    """Add ``nouns``: by a tagger if given, by a (word, lemma, pos) lexicon if given, else all plain words."""
    if models.tagger:

        @F.pandas_udf("array<string>")
        def tag(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            nouns = models.tagger()
            for texts in batches:
                yield texts.map(lambda t: list(nouns(t or "")))

        bounded_batches(df.sparkSession)
        return df.withColumn("nouns", tag(F.col("text")))
    nouns = tx.terms(F.col("text"), stop_words)
    if lexicon is None:
        return df.withColumn("nouns", nouns)
    known = broadcast_if_small(lexicon.where("pos = 'NOUN'").groupBy("word").agg(F.min("lemma").alias("lemma")))
    found = (
        df.select("article_id", F.posexplode(nouns).alias("pos", "word"))
        .join(known, "word")
        .groupBy("article_id")
        .agg(F.sort_array(F.collect_list(F.struct("pos", F.lower("lemma").alias("lemma")))).alias("x"))
        .select("article_id", F.transform("x", lambda x: x["lemma"]).alias("nouns"))
    )
    joined = df.join(found, "article_id", "left")
    return joined.withColumn("nouns", F.coalesce("nouns", F.array().cast("array<string>")))


# --- topic and sentiment ------------------------------------------------------


def _lexicon_hits(df: DataFrame, lexicon: DataFrame, column: str) -> DataFrame:
    words = tx.explode_words(df, tx.words(F.col(column)), "article_id")
    return words.join(broadcast_if_small(lexicon), "word")


def topic_scores(df: DataFrame, lexicon: DataFrame, column: str = "summary") -> DataFrame:
    """(article_id, topic, score) over a (word, topic, weight) lexicon."""
    return _lexicon_hits(df, lexicon, column).groupBy("article_id", "topic").agg(F.sum("weight").alias("score"))


def classify_topic(df: DataFrame, lexicon: DataFrame, column: str = "summary") -> DataFrame:
    """Add ``topic``: the highest score, the first in the alphabet among equals, 'unknown' without any hit."""
    best = topic_scores(df, lexicon, column).groupBy("article_id").agg(
        F.min(F.struct((-F.col("score")).alias("o"), "topic"))["topic"].alias("topic")
    )
    return df.drop("topic").join(best, "article_id", "left").withColumn("topic", F.coalesce("topic", F.lit("unknown")))


def classify_sentiment(df: DataFrame, lexicon: DataFrame, column: str = "summary") -> DataFrame:
    """Add ``sentiment`` from a (word, polarity) lexicon: the sign of the sum, and its size per hit as score."""
    hits = _lexicon_hits(df, lexicon, column).groupBy("article_id").agg(F.sum("polarity").alias("p"), F.count("*").alias("n"))
    label = F.when(F.col("n").isNull(), "unknown").when(F.col("p") >= 0, "POSITIVE").otherwise("NEGATIVE")
    score = F.coalesce(F.abs(F.col("p")) / F.col("n"), F.lit(0.0))
    joined = df.drop("sentiment").join(hits, "article_id", "left")
    return joined.withColumn("sentiment", F.struct(label.alias("label"), score.cast("double").alias("score"))).drop("p", "n")


def topic_lexicon(spark, topics: list[str]) -> DataFrame:
    """Default lexicon: the words of the topic names, one point each."""
    rows = [(w, t, 1.0) for t in topics for w in t.split() if w != "and"]
    return spark.createDataFrame(rows, "word string, topic string, weight double")


def classify(df: DataFrame, topics: DataFrame, polarity: DataFrame, models: Models = Models()) -> DataFrame:
    """Add summary, topic, sentiment and status to articles.

    Texts of at most 200 characters stand for themselves, longer ones are summarised. Topic and sentiment each come from
    an injected model where there is one, else from the lexicon. A row whose model call fails gets status 'failed'; all
    others 'ok'.
    """
    if not (models.topic or models.sentiment):
        short = F.length("text") <= 200
        rows = choose_summary(df.withColumn("summary", F.when(short, F.col("text"))), models)
        rows = stage(rows, "summaries")  # read by each lexicon and for the rows; the summariser runs once
        return classify_sentiment(classify_topic(rows, topics), polarity).withColumn("status", F.lit("ok"))
    kept = [f for f in df.schema.fields if f.name not in ("summary", "topic", "sentiment", "status")]
    sentiment = T.StructType([T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType())])
    schema = T.StructType(
        kept
        + [T.StructField("summary", T.StringType()), T.StructField("topic", T.StringType())]
        + [T.StructField("sentiment", sentiment), T.StructField("status", T.StringType())]
    )

    def run(batches):
        topic = models.topic() if models.topic else None
        mood = models.sentiment() if models.sentiment else None
        make = models.summariser() if models.summariser else salient_sentences
        count = models.tokens() if models.tokens else _word_count

        def one(text: str):
            try:
                body = text if len(text) <= 200 else summarize_text(text, make, count)
                labels = (topic(body).get("labels") or ["unknown"]) if topic else [None]
                found = mood(body) if mood else {}
                return body, labels[0], {"label": found.get("label"), "score": found.get("score")}, "ok"
            except Exception:
                return None, None, None, "failed"

        for pdf in batches:
            out = pdf[[f.name for f in kept]].copy()
            results = [one(t) for t in pdf["text"]]
            for i, name in enumerate(("summary", "topic", "sentiment", "status")):
                out[name] = pd.Series([r[i] for r in results], index=out.index, dtype="object")
            yield out

    bounded_batches(df.sparkSession)
    rows = df.mapInPandas(run, schema)
    if models.topic and models.sentiment:
        return rows
    rows = cut(rows)  # the models ran once; what they left open comes from the lexicon
    ok = rows.where("status = 'ok'")
    ok = classify_sentiment(ok, polarity) if models.topic else classify_topic(ok, topics)
    return ok.select(*rows.columns).unionByName(rows.where("status <> 'ok'"))


# --- vectors -----------------------------------------------------------------

# Enough slots that rare words seldom share one: the search for similar texts meets them by their rarest slots.
DIMENSIONS = 262_144
Hash = Callable[[Column], Column]


def portable_hash(word: Column) -> Column:
    """A hash of 32 bits that other engines have too: the front of the MD5."""
    return F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("long")


def vector_text() -> Column:
    """Summary, else text."""
    return F.coalesce(tx.blank_to_null(F.col("summary")), tx.blank_to_null(F.col("text")))


def _slots(df: DataFrame, text: Column, dims: int, hashed: Hash) -> DataFrame:
    """(article_id, slots): the slots of all words of an article in one row. Its words never become rows of a shuffle.

    Only where an id comes more than once are rows moved, to bring its words together.
    """
    slots = F.transform(tx.words(text), lambda w: F.pmod(hashed(w), F.lit(dims)).cast("int"))
    rows = df.select("article_id", F.coalesce(slots, F.array().cast("array<int>")).alias("slots"))
    if not df.groupBy("article_id").count().where("count > 1").limit(1).count():
        return rows
    return rows.groupBy("article_id").agg(F.flatten(F.collect_list("slots")).alias("slots"))


def fit_idf(df: DataFrame, text: Column | None = None, dims: int = DIMENSIONS, hashed: Hash = F.xxhash64) -> DataFrame:
    """(slot, idf, n): at most ``dims`` rows, ``n`` being the number of texts. Fit once, store, and use for all days to be compared."""
    text = vector_text() if text is None else text
    n = df.agg(F.count("*")).first()[0]
    seen = _slots(df, text, dims, hashed).select(F.explode(F.array_distinct("slots")).alias("slot")).groupBy("slot").agg(F.count("*").alias("df"))
    return cut(seen.select("slot", (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1).alias("idf"), F.lit(n).cast("long").alias("n")))


def embed_text(df: DataFrame, idf: DataFrame, text: Column | None = None, dims: int = DIMENSIONS, hashed: Hash = F.xxhash64) -> DataFrame:
    """(article_id, vec): hashed TF-IDF vector of length 1, sparse. Rows without words give none.

    Slots that the weight table has not seen have the weight of a word in no text, ln(1 + n) + 1, so no word is lost.
    The table, at most ``dims`` numbers, goes to the tasks; an article's vector is worked out in its own row.
    """
    text = vector_text() if text is None else text
    n = idf.agg(F.max("n")).first()[0] if "n" in idf.columns else None
    weight = np.full(dims, np.log(1 + (n or 0)) + 1)
    known = idf.where((F.col("slot") >= 0) & (F.col("slot") < dims)).select(F.col("slot").cast("int"), F.col("idf").cast("double")).where("idf is not null").toPandas()
    weight[known["slot"].to_numpy()] = known["idf"].to_numpy()
    rows = _slots(df, text, dims, hashed).where(F.size("slots") > 0)
    indices, values = T.ArrayType(T.IntegerType(), False), T.ArrayType(T.DoubleType(), False)
    vec = T.StructType([T.StructField("indices", indices, False), T.StructField("values", values, False)])

    def run(batches):
        for batch in batches:
            slots = batch.column(1)
            size = slots.value_lengths().to_numpy(zero_copy_only=False)
            cell, tf = np.unique(np.repeat(np.arange(len(size)), size) * dims + slots.flatten().to_numpy(), return_counts=True)
            row, slot = cell // dims, cell % dims
            x = tf * weight[slot]
            x = x / (np.sqrt(np.bincount(row, weights=x * x, minlength=len(size))) + EPS)[row]
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(size)))]).astype("int32"))
            lists = [pa.ListArray.from_arrays(ends, pa.array(a)) for a in (slot.astype("int32"), x)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.StructArray.from_arrays(lists, ["indices", "values"])], ["article_id", "vec"])

    bounded_batches(df.sparkSession)
    return rows.mapInArrow(run, T.StructType([df.schema["article_id"], T.StructField("vec", vec)]))


def embed_with(df: DataFrame, models: Models, text: Column | None = None) -> DataFrame:
    """(article_id, vec) from an injected embedder, loaded once per task, scaled to length 1."""
    text = vector_text() if text is None else text

    def run(batches):
        model = models.embedder()
        for pdf in batches:
            if len(pdf):
                x = np.asarray(model(pdf["text"].tolist()), dtype="float32")
                x = x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-9)
                yield pd.DataFrame({"article_id": pdf["article_id"], "vec": list(x)})

    bounded_batches(df.sparkSession)
    rows = df.select("article_id", text.alias("text")).where("text is not null")
    return rows.mapInPandas(run, "article_id long, vec array<float>")


def _unit(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, T.StructType):
        values = l2_normalize(F.col(f"{column}.values"))
        return F.struct(F.col(f"{column}.indices").alias("indices"), values.alias("values"))
    return l2_normalize(F.col(column))


def reuse_flags(df: DataFrame, column: str = "embedding", shortest: int = 10) -> DataFrame:
    """(sample, reuse): whether every row of the sample has a usable stored vector.

    A dense vector must have ``shortest`` positions, a sparse one must be there.
    """
    sparse = isinstance(df.schema[column].dataType, T.StructType)
    good = F.col(column).isNotNull() if sparse else F.coalesce(F.size(column) >= shortest, F.lit(False))
    return df.groupBy("sample").agg(F.every(good).alias("reuse"))


def resolve_vectors(df: DataFrame, compute: Callable[[DataFrame], DataFrame], column: str = "embedding") -> DataFrame:
    """(article_id, sample, vec, reuse): stored vectors where a whole sample has them, else all computed anew.

    Stored and computed vectors of a sample never mix. ``compute`` gives (article_id, vec)
    in the form of the stored column.
    """
    flagged = df.join(reuse_flags(df, column), "sample")
    kept = flagged.where("reuse").select("article_id", "sample", _unit(df, column).alias("vec"), "reuse")
    anew = flagged.where("not reuse")
    made = compute(anew).join(anew.select("article_id", "sample", "reuse"), "article_id")
    return kept.unionByName(made.select("article_id", "sample", "vec", "reuse"))
