"""Main text of pages that do not mark their article."""

from pyspark.sql import functions as F

from newstide.sources.maintext import main_text, read_entities


def test_entities(spark):
    cases = [
        ("a &amp; b", "a & b"), ("&#233;&#xE9;&#x1F600;", "éé😀"), ("&amp;#39; &#38;lt;", "&#39; &lt;"), ("&unknown; & &", "&unknown; & &"),
        ("&#0;&#55296;&#9999999;&#;", "&#0;&#55296;&#9999999;&#;"), ("", ""), ("plain", "plain"), ("&lt;&gt", "<&gt"), (None, None),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    assert [r.t for r in df.select("i", read_entities(F.col("t")).alias("t")).orderBy("i").collect()] == [want for _, want in cases]


def test_main_text(spark):
    long, other = "A sentence of the story that goes on for quite a while. " * 3, "Another paragraph, as long as the one before, or longer still. " * 2
    menu = "<ul>" + "".join(f'<li><a href="/{i}">A link of the menu with a rather long text number {i}</a></li>' for i in range(9)) + "</ul>"
    story = f"<div>{long}</div><p>Short.</p><p>{other} <a href='/x'>more</a></p>"
    cases = [
        (f"<html><head><title>{long * 9}</title></head><body>{menu}{story}{menu}</body></html>", f"{long.strip()}\nShort.\n{other.strip()} more"),
        (f"<article><p>Marked.</p></article>{story}", "Marked."), (f"<article> </article><p>{long}</p>", long.strip()),
        ("<p>Only this.</p>", "Only this."), ("<a href='/a'>One link", "One link"), ("caf&#233; <br> x", "café"), ("<p> </p>", None), ("", None), (None, None),
        ("<p>" + "w " * 100_000 + "</p>", ("w " * 100_000).strip()),
    ]
    df = spark.createDataFrame([(i, h, "kept") for i, (h, _) in enumerate(cases)], "i int, html string, extra string")
    out = main_text(df)
    assert out.columns == ["i", "html", "extra", "text"]
    assert [r.text for r in out.orderBy("i").collect()] == [want for _, want in cases]
    assert main_text(df.where("false")).count() == 0
