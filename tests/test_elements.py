"""Links of pages by attributes and inner elements."""

from pyspark.sql import functions as F

from newstide.sources.elements import attr, elements, has_class, inner_text, select_links, tag_stream

SCHEMA = "page_id long, url string, html string, text string"


def frame(spark, *htmls):
    return spark.createDataFrame([(i, "https://h.example/x/y", h, "kept") for i, h in enumerate(htmls)], SCHEMA)


def links(df):
    return [(r.page_id, r.pos, r.url, r.title) for r in df.orderBy("page_id", "pos").collect()]


def test_attributes(spark):
    html = """<A Href=/a class='x  card' DATA-K="a &amp; b > c" checked data-k=later><i class="cardinal"></i></A>"""
    rows = tag_stream(frame(spark, html)).where("tag = 'a' and not closes")
    got = rows.select(attr("href").alias("h"), attr("data-k").alias("k"), attr("checked").alias("c"), attr("none").alias("n"), has_class("card").alias("y"), has_class("car").alias("m")).first()
    assert tuple(got) == ("/a", "a & b > c", "", None, True, False)


def test_nested_and_unclosed_elements(spark):
    html = "<div>a<div>b</div>c</div><p>one<p>two</p><i>three</i></div><div>open <b>end"
    df = frame(spark, html)
    found = inner_text(elements(tag_stream(df)), df).orderBy("pos").collect()
    assert [(r.tag, r.text) for r in found] == [("div", "ab\nc"), ("div", "b"), ("p", "one"), ("p", "two"), ("i", "three"), ("div", "open end"), ("b", "end")]


def test_select_links(spark):
    card = "<a href='/news/1' data-link-type=article><span>no</span><h2 class='headline'>One &amp; <b>more</b></h2><h2>Second</h2></a>"
    cases = [
        card + "<h2>outside</h2><a href='/other'><h2>Other</h2></a>",
        "<h2>before</h2><a href='https://z.example/news'><h2> </h2></a><a data-link-type='article'><h2>no address</h2></a>",
        "<script>var t = \"<a href='/news/9'><h2>script</h2></a>\";</script><!-- <a href='/news/8'><h2>comment</h2></a> -->" + card,
        "<a href='/news/2'><h2>never closed", "<a href='/news/3'><img alt='>'><h2>Three</h2>", "no tags < at > all", "", None,
    ]
    df = frame(spark, *cases)
    news = attr("href").startswith("/news")
    every = links(select_links(df, news, F.col("tag") == "h2", first=False))
    host = "https://h.example"
    one = [(0, f"{host}/news/1", "One & more"), (1, f"{host}/news/1", "Second")]
    assert every == [(i, *r) for i in (0, 2) for r in one] + [(3, 0, f"{host}/news/2", "never closed"), (4, 0, f"{host}/news/3", "Three")]
    first = links(select_links(df, attr("data-link-type") == "article", has_class("headline") | (F.col("tag") == "h2")))
    assert first == [(0, 0, f"{host}/news/1", "One & more"), (2, 0, f"{host}/news/1", "One & more")]
    own = links(select_links(df.where("page_id = 4"), news))
    assert own == [(4, 0, f"{host}/news/3", "Three")]
    assert select_links(df.where("false"), news).count() == 0


def test_long_page(spark):
    df = frame(spark, "<div>" * 3000 + "".join(f"<a href='/n/{i}'><h2>T{i}</h2></a>" for i in range(3000)) + "w " * 500_000)
    got = links(select_links(df, attr("href").startswith("/n/"), F.col("tag") == "h2"))
    assert [g[3] for g in got] == [f"T{i}" for i in range(3000)]
