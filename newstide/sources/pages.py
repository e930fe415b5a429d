"""Landed web pages: links and article text, by native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.functions.text import blank_to_null, strip
from newstide.functions.urls import absolute_url

ENTITIES = {
    "&nbsp;": " ",
    "&quot;": '"',
    "&apos;": "'",
    "&#39;": "'",
    "&lt;": "<",
    "&gt;": ">",
    "&copy;": "©",
    "&middot;": "·",
    "&ndash;": "–",
    "&mdash;": "—",
    "&hellip;": "…",
    "&euro;": "€",
    "&amp;": "&",  # last, so that escaped entities are read once
}


def unescape(col: Column) -> Column:
    for name, char in ENTITIES.items():
        col = F.replace(col, F.lit(name), F.lit(char))
    return col


def plain_text(html: Column) -> Column:
    """Text without tags: block ends become newlines, blanks collapse, entities are read."""
    text = F.regexp_replace(html, r"(?is)<!--.*?-->", "")
    text = F.regexp_replace(text, r"(?is)<(script|style|nav|aside|footer|noscript)\b[^>]*>.*?</(script|style|nav|aside|footer|noscript)>", "")
    text = F.regexp_replace(text, r"(?i)<br\s*/?>|</(p|div|li|h[1-6]|tr|blockquote)>", "\n")
    text = unescape(F.regexp_replace(text, r"(?s)<[^>]*>", ""))
    text = F.regexp_replace(text, r"[ \t]+", " ")
    return strip(F.regexp_replace(text, r" ?\n[ \n]*", "\n"))


def article_text(html: Column) -> Column:
    """Main text of a page, or null when its article region is missing or empty."""
    return blank_to_null(plain_text(F.nullif(F.regexp_extract(html, r"(?is)<article\b[^>]*>(.*?)</article>", 1), F.lit(""))))


def extract_article_text(pages: DataFrame) -> DataFrame:
    return pages.withColumn("text", article_text(F.col("html")))


def page_title(html: Column) -> Column:
    return blank_to_null(plain_text(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)))


def harvest_links(pages: DataFrame, href_prefix: str = "") -> DataFrame:
    """Anchors of each page as (page_id, pos, url, title); only those under ``href_prefix``."""
    anchor = r'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
    found = F.arrays_zip(
        F.regexp_extract_all("html", F.lit(anchor), F.lit(1)).alias("href"),
        F.regexp_extract_all("html", F.lit(anchor), F.lit(2)).alias("inner"),
    )
    return (
        pages.select("page_id", F.col("url").alias("base"), F.posexplode(found).alias("pos", "a"))
        .where((F.col("a.href") != "") & F.col("a.href").startswith(href_prefix))
        .select(
            "page_id",
            "pos",
            absolute_url(F.col("a.href"), F.col("base")).alias("url"),
            plain_text(F.col("a.inner")).alias("title"),
        )
    )


def bodies(pages: DataFrame) -> DataFrame:
    """(url, text) of the pages that have a body, one row per url, for joining to feed entries."""
    return (
        extract_article_text(pages)
        .where("text is not null")
        .groupBy("url")
        .agg(F.min_by("text", "page_id").alias("text"))
    )
