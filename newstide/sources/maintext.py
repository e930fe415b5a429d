"""Main text of pages that do not mark their article: the run of blocks with the most text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.functions.text import blank_to_null, strip
from newstide.sources.pages import ENTITIES, article_text

# Characters a block must have beside those of its links to speak for itself.
SHORTEST_BLOCK = 40


def read_entities(col: Column) -> Column:
    """Named and numeric character references, each read once; unknown ones and impossible numbers stay as they are."""
    names = F.create_map(*[F.lit(x) for name, char in ENTITIES.items() if "#" not in name for x in (name[1:-1], char)])

    def read(part: Column) -> Column:
        name = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z]+);", 1)
        hexed = F.lower(F.substring(name, 2, 1)) == "x"
        code = F.when(hexed, F.conv(F.substring(name, 3, 6), 16, 10)).otherwise(F.substring(name, 2, 7))
        code = F.when(name.startswith("#"), code.try_cast("int"))
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        # A code that is no character never reaches the decoder.
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0")), "UTF-32")
        char = F.coalesce(F.when(name.startswith("#"), char), names[name])
        return F.when(char.isNull(), F.concat(F.lit("&"), part)).otherwise(F.concat(char, F.substr(part, F.length(name) + 2)))

    parts = F.split(col, "&")
    rest = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), read)
    return F.when(~col.contains("&"), col).otherwise(F.concat(F.get(parts, F.lit(0)), F.array_join(rest, "")))


def blocks(html: Column) -> Column:
    """Text blocks of a page as array<struct<text, score>>, in order, without empty ones.

    The score is the length of the text outside links, less that inside links, less ``SHORTEST_BLOCK``.
    """
    text = F.translate(html, "\x01\x02", "")
    text = F.regexp_replace(text, r"(?is)<!--.*?-->", "")
    text = F.regexp_replace(text, r"(?is)<(head|script|style|nav|aside|footer|noscript)\b[^>]*>.*?</(head|script|style|nav|aside|footer|noscript)>", "")
    text = F.regexp_replace(text, r"(?i)<br\s*/?>|</?(p|div|li|ul|ol|h[1-6]|tr|table|section|blockquote)\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"(?i)<a\b[^>]*>", "\x01")
    text = F.regexp_replace(text, r"(?i)</a>", "\x02")
    text = read_entities(F.regexp_replace(text, r"(?s)<[^>]*>", ""))
    lines = F.transform(F.split(F.regexp_replace(text, r"[ \t]+", " "), "\n"), lambda x: strip(x))

    def scored(line: Column) -> Column:
        outside = F.length(F.translate(F.regexp_replace(line, "\x01[^\x02]*\x02", ""), "\x01\x02", ""))
        whole = F.translate(line, "\x01\x02", "")
        return F.struct(whole.alias("text"), (2 * outside - F.length(whole) - SHORTEST_BLOCK).alias("score"))

    return F.filter(F.transform(lines, scored), lambda b: strip(b["text"]) != "")


def best_run(found: Column) -> Column:
    """Text of the run of blocks with the greatest sum of scores, in one fold; the first of equals, without a leading part of sum 0.

    Null for no blocks; where no sum is above 0 the block with the highest score.
    """
    state = "struct<at:int,sum:int,start:int,best:int,first:int,last:int>"
    empty = F.struct(*[F.lit(v).alias(n) for n, v in (("at", 0), ("sum", 0), ("start", 0), ("best", None), ("first", 0), ("last", -1))]).cast(state)

    def step(s: Column, b: Column) -> Column:
        on = s["sum"] > 0
        total, start = F.when(on, s["sum"]).otherwise(0) + b["score"], F.when(on, s["start"]).otherwise(s["at"])
        better = s["best"].isNull() | (total > s["best"])
        return F.struct(
            (s["at"] + 1).alias("at"), total.alias("sum"), start.alias("start"), F.when(better, total).otherwise(s["best"]).alias("best"),
            F.when(better, start).otherwise(s["first"]).alias("first"), F.when(better, s["at"]).otherwise(s["last"]).alias("last"),
        ).cast(state)

    run = F.aggregate(found, empty, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))
    kept = F.transform(F.slice(found, run["first"] + 1, run["last"] - run["first"] + 1), lambda b: b["text"])
    return blank_to_null(F.array_join(kept, "\n"))


def main_text(pages: DataFrame) -> DataFrame:
    """Add ``text``: the article region, else the best run of blocks; null only for pages without text (or null ones)."""
    found = pages.withColumn("_region", article_text(F.col("html"))).withColumn("_blocks", F.when(F.col("_region").isNull(), blocks(F.col("html"))))
    return found.withColumn("text", F.coalesce("_region", best_run(F.col("_blocks")))).drop("_region", "_blocks")
