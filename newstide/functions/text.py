"""Text expressions. All are native columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newstide.config import (
    BOILERPLATE_KEYWORDS,
    ENGLISH_STOP_WORDS,
    PHOTO_CREDIT_PATTERN,
    SENTENCE_BREAK_PATTERN,
    UNTITLED,
    WHITESPACE,
    WORD_PATTERN,
)


def strip(col: Column) -> Column:
    """Remove white space, including the Unicode kinds, from both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    return F.nullif(strip(col), F.lit(""))


def coerce_text(col: Column, dtype: T.DataType) -> Column:
    """Text of a value of any declared type; never null, always stripped.

    Binary is read as UTF-8 with malformed bytes left out, arrays are joined by
    newlines, a struct with a text-like ``text`` field gives that field and
    everything else its string form.
    """
    if isinstance(dtype, T.BinaryType):
        # Malformed sequences become U+FFFD, which is then dropped.
        text = F.replace(F.make_valid_utf8(col.cast("string")), F.lit("\ufffd"), F.lit(""))
    elif isinstance(dtype, T.ArrayType):
        text = F.array_join(F.transform(col, lambda x: coerce_text(x, dtype.elementType)), "\n")
    elif isinstance(dtype, T.StructType) and _has_text(dtype):
        return coerce_text(col["text"], dtype["text"].dataType)
    else:
        text = col.cast("string")
    return F.coalesce(strip(text), F.lit(""))


def coerce_variant(value: Column, depth: int = 3) -> Column:
    """``coerce_text`` of a VARIANT, whose type is decided row by row; never null, always stripped.

    Lists are joined by newlines, an object whose ``text`` is text or a list gives that, everything else its string form.
    Beyond ``depth`` levels of nesting values take their string form, which for lists and objects is JSON.
    """
    plain = F.coalesce(strip(F.try_variant_get(value, "$", "string")), F.lit(""))
    if depth == 0:
        return plain
    items = F.try_variant_get(value, "$", "array<variant>")
    inner = F.try_variant_get(value, "$.text", "variant")
    kind = F.schema_of_variant(inner)
    joined = strip(F.array_join(F.transform(items, lambda x: coerce_variant(x, depth - 1)), "\n"))
    return (
        F.when(items.isNotNull(), joined)
        .when((kind == "STRING") | kind.startswith("ARRAY"), coerce_variant(inner, depth - 1))
        .otherwise(plain)
    )


def _has_text(dtype: T.StructType) -> bool:
    return "text" in dtype.names and isinstance(
        dtype["text"].dataType, (T.StringType, T.BinaryType, T.ArrayType)
    )


def join_paragraphs(col: Column, element: T.DataType = T.StringType()) -> Column:
    parts = F.filter(F.transform(col, lambda x: coerce_text(x, element)), lambda s: s != "")
    return F.coalesce(strip(F.array_join(parts, "\n")), F.lit(""))


def safe_len(col: Column, dtype: T.DataType) -> Column:
    """Length of text, binary, array or map; 0 for null and for types without length."""
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        size = F.size(col)
        return F.when(col.isNull(), F.lit(0)).otherwise(size)
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.length(col), F.lit(0))
    return F.lit(0)


def has_min_chars(col: Column, dtype: T.DataType, min_chars: int = 1) -> Column:
    return F.length(coerce_text(col, dtype)) >= min_chars


def title_or_default(col: Column) -> Column:
    return F.coalesce(blank_to_null(col), F.lit(UNTITLED))


def is_photo_credit(col: Column) -> Column:
    return F.coalesce(col.rlike("(?i)" + PHOTO_CREDIT_PATTERN), F.lit(False))


def is_boilerplate(line: Column, keywords: list[str] | None = None) -> Column:
    """True when the lower-cased line contains one of the keywords."""
    low = F.lower(line)
    hit = F.lit(False)
    for word in BOILERPLATE_KEYWORDS if keywords is None else keywords:
        hit = hit | low.contains(word)
    return hit


def drop_boilerplate(col: Column, keywords: list[str] | None = None) -> Column:
    """The text without its boilerplate lines."""
    return F.array_join(F.filter(F.split(col, "\n"), lambda x: ~is_boilerplate(x, keywords)), "\n")


def sentences(col: Column) -> Column:
    return F.split(col, SENTENCE_BREAK_PATTERN)


def token_count(col: Column) -> Column:
    """Number of runs of non-blank characters."""
    return F.regexp_count(col, F.lit(r"\S+"))


def chunks(col: Column, max_tokens: int = 512) -> Column:
    """Greedy packing of whole sentences into chunks of at most ``max_tokens``.

    A sentence longer than the limit forms a chunk of its own. One pass over the
    sentence array carries the finished chunks and the open one.
    """
    state = "struct<done:array<string>,open:string,n:int>"
    empty = F.struct(
        F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("n")
    ).cast(state)

    def flush(acc: Column) -> Column:
        return F.when(acc["open"] == "", acc["done"]).otherwise(
            F.array_append(acc["done"], strip(acc["open"]))
        )

    def step(acc: Column, sentence: Column) -> Column:
        size = token_count(sentence)
        full = acc["n"] + size > max_tokens
        glue = F.when(acc["open"] == "", F.lit("")).otherwise(F.lit(" "))
        return F.struct(
            F.when(full, flush(acc)).otherwise(acc["done"]).alias("done"),
            F.when(full, sentence).otherwise(F.concat(acc["open"], glue, sentence)).alias("open"),
            F.when(full, size).otherwise(acc["n"] + size).alias("n"),
        ).cast(state)

    return F.aggregate(sentences(col), empty, step, flush)


def summary_budget(tokens: Column) -> tuple[Column, Column]:
    """(longest, shortest) summary length for a chunk of that many tokens."""
    longest = F.when(
        tokens < 200, F.greatest(F.floor(tokens * F.lit(0.8)).cast("int"), F.lit(20))
    ).otherwise(F.lit(200))
    shortest = F.when(tokens < 200, F.least(F.lit(10), F.floor(longest / 2).cast("int"))).otherwise(F.lit(80))
    return longest, shortest


def words(col: Column) -> Column:
    """Lower-cased word tokens of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(col), F.lit(f"({WORD_PATTERN})"), F.lit(1))


def without_stop_words(tokens: Column, stop_words: list[str] | None = None) -> Column:
    stops = ENGLISH_STOP_WORDS if stop_words is None else stop_words
    return F.filter(tokens, lambda w: ~w.isin(stops))


def explode_words(df: DataFrame, tokens: Column, *keep: str, name: str = "word") -> DataFrame:
    """One row per token, beside the kept columns.

    A plain explode would also filter on the size of the array, which works the
    tokens out a second time below it; the outer form with a null check does not.
    """
    rows = df.select(*keep, F.explode_outer(tokens).alias(name))
    return rows.where(F.col(name).isNotNull())


def one_and_two_grams(tokens: Column) -> Column:
    """The tokens and each pair of neighbours joined by a blank."""
    pairs = F.when(
        F.size(tokens) > 1,
        F.zip_with(
            F.slice(tokens, F.lit(1), F.size(tokens) - 1),
            F.slice(tokens, F.lit(2), F.size(tokens) - 1),
            lambda a, b: F.concat_ws(" ", a, b),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(tokens, pairs)


def terms(col: Column, stop_words: list[str] | None = None) -> Column:
    """Default noun stand-in: lower-cased alphabetic tokens that are no stop words.

    There is no part-of-speech tagger here; inject one, or pass a lexicon to
    ``operators.models.extract_terms``, where nouns proper are needed.
    """
    tokens = F.regexp_extract_all(F.lower(col), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
    stops = ENGLISH_STOP_WORDS if stop_words is None else stop_words
    return F.filter(tokens, lambda w: w.rlike(r"^\p{L}+$") & ~w.isin(stops))
