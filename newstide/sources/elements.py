"""Elements of pages as rows, on which a selector is a filter.

A selector is a boolean column over ``tag`` and ``attr(name)``: ``a[href^='/news']`` is
``(F.col("tag") == "a") & attr("href").startswith("/news")``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newstide.functions.text import strip
from newstide.functions.urls import absolute_url
from newstide.sources.maintext import read_entities
from newstide.sources.pages import plain_text

#: Elements that end where the next one of their name begins, and those without content.
NOT_NESTED = ("a", "p", "h1", "h2", "h3", "h4", "h5", "h6", "button", "option", "title")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")

HIDDEN = r"(?is)<!--.*?-->|<(script|style|noscript)\b[^>]*>.*?</\1\s*>"
TAG = r"""<(/?[a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
ATTRIBUTE = r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?"""
# Private marks that cut a page into its tags.
CUT = "\x01"


def pieces(html: Column) -> Column:
    """The page cut before each tag: the first piece is what precedes all tags, any other starts with its tag."""
    shown = F.regexp_replace(F.translate(html, CUT, ""), HIDDEN, "")
    return F.split(F.regexp_replace(shown, TAG, CUT + "$0"), CUT)


def tag_stream(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per tag: (key, pos, tag, closes, names, quoted), in order of ``pos`` from 1; attribute values still quoted."""
    cut = pages.select(F.col(key), F.posexplode(pieces(F.col("html"))).alias("pos", "piece")).where("pos > 0")
    inside = F.regexp_extract("piece", TAG, 2)
    name = F.lower(F.regexp_extract("piece", TAG, 1))
    return cut.select(
        key,
        "pos",
        F.ltrim(name, F.lit("/")).alias("tag"),
        name.startswith("/").alias("closes"),
        F.transform(F.regexp_extract_all(inside, F.lit(ATTRIBUTE), F.lit(1)), F.lower).alias("names"),
        F.regexp_extract_all(inside, F.lit(ATTRIBUTE), F.lit(2)).alias("quoted"),
    )


def attr(name: str) -> Column:
    """Value of an attribute, the first of its name; empty when it has none, null when it is not there."""
    at = F.array_position("names", name.lower())
    raw = F.get(F.col("quoted"), F.when(at > 0, at - 1).cast("int"))
    quote = F.left(raw, F.lit(1))
    return read_entities(F.when(quote.isin('"', "'"), F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw))


def has_class(name: str) -> Column:
    return F.coalesce(F.array_contains(F.split(attr("class"), r"\s+"), name), F.lit(False))


def elements(tags: DataFrame, key: str = "page_id") -> DataFrame:
    """Opening tags with ``until``, the position of the tag that ends them; null where the page ends first.

    Depth is a running sum per name, so tags of other names that were never closed do no harm.
    """
    by_name = Window.partitionBy(key, "tag").orderBy("pos")
    step = F.when(F.col("closes"), -1).otherwise(1)
    depth = F.sum(step).over(by_name) + F.when(F.col("closes"), 1).otherwise(0)
    level = F.when(F.col("tag").isin(*NOT_NESTED), 0).otherwise(depth)
    ends = F.when(F.col("tag").isin(*VOID), F.col("pos") + 1).otherwise(F.lead("pos").over(Window.partitionBy(key, "tag", "level").orderBy("pos")))
    return tags.withColumn("level", level).withColumn("until", ends).where(~F.col("closes")).drop("level", "closes")


def inner_text(found: DataFrame, pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Add ``text``, the plain text between ``pos`` and ``until``; pages are joined once, with all that was found in them."""
    held = found.groupBy(key).agg(F.collect_list(F.struct(*[c for c in found.columns if c != key])).alias("_found"))
    joined = pages.select(key, pieces(F.col("html")).alias("_pieces")).join(held, key)
    # The arrays count from 1 and hold the text before the first tag, so a tag's own piece is at pos + 1.
    end = F.coalesce(F.col("_f.until"), F.size("_pieces"))
    own = F.slice("_pieces", F.col("_f.pos") + 1, F.greatest(end - F.col("_f.pos"), F.lit(0)))
    # Attributes go first: their values may hold what looks like the end of a tag.
    inside = F.array_join(F.transform(own, lambda piece: F.regexp_replace(piece, TAG, "<$1>")), "")
    return joined.select(key, "_pieces", F.explode("_found").alias("_f")).select(key, "_f.*", plain_text(inside).alias("text"))


def select_links(pages: DataFrame, link: Column, title: Column | None = None, first: bool = True, key: str = "page_id") -> DataFrame:
    """Links of pages as (key, pos, url, title): anchors that ``link`` selects, titled by an element inside them.

    ``title`` selects the inner element: the first of each link, or with ``first=False`` each of them as a row of its own. Links
    without one are left out. Without ``title`` the text of the anchor itself is taken. ``pos`` numbers the
    rows of a page from 0. Links without an address, and those whose title is empty, are left out. ``key`` must tell pages apart;
    null and empty pages have no links.
    """
    found = elements(tag_stream(pages, key), key)
    order = Window.partitionBy(key).orderBy("pos")
    is_link = F.coalesce((F.col("tag") == "a") & link, F.lit(False))
    anchor = F.struct(F.col("pos").alias("start"), F.coalesce("until", F.lit(2**31 - 1)).alias("until"), attr("href").alias("href"))
    # Anchors are not nested: the last one that began is the only one a later element can lie in.
    around = F.last(F.when(F.col("tag") == "a", F.struct(is_link.alias("taken"), anchor.alias("a"))), ignorenulls=True)
    if title is None:
        rows = found.where(is_link).select(key, "pos", "until", anchor.alias("a"))
    else:
        inner = found.withColumn("_in", around.over(order.rowsBetween(Window.unboundedPreceding, -1)))
        rows = inner.where(F.coalesce(title, F.lit(False)) & F.col("_in.taken") & (F.col("pos") < F.col("_in.a.until"))).select(key, "pos", "until", F.col("_in.a").alias("a"))
        if first:
            rows = rows.groupBy(key, F.col("a.start").alias("_start")).agg(F.min(F.struct("pos", "until")).alias("_e"), F.min("a").alias("a"))
            rows = rows.select(key, "_e.*", "a")
    texts = inner_text(rows.where("a.href <> ''"), pages, key).where(strip(F.col("text")) != "")
    based = pages.select(key, F.col("url").alias("_base")).join(texts, key)
    return based.select(
        key,
        (F.row_number().over(order) - 1).alias("pos"),
        absolute_url(F.col("a.href"), F.col("_base")).alias("url"),
        F.col("text").alias("title"),
    )
