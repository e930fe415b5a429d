"""Feed pages whose fields change type from entry to entry."""

import json

from pyspark.sql import functions as F

from newstide.functions.text import coerce_variant
from newstide.sources.feeds import read_feed_variant


def test_coerce_variant(spark):
    cases = [
        ('"  a b\\u00a0"', "a b"), ("null", ""), ("12", "12"), ("true", "true"), ('["x", null, " y ", 3]', "x\n\ny\n3"), ("[]", ""),
        ('{"text": " t "}', "t"), ('{"text": ["p", {"text": "q"}]}', "p\nq"), ('{"text": 5}', '{"text":5}'), ('{"text": null}', '{"text":null}'),
        ('{"title": "only"}', '{"title":"only"}'), ('[[["deep"]]]', "deep"), ('[[[["deeper"]]]]', '["deeper"]'), ("{}", "{}"), ("no json", ""),
    ]
    df = spark.createDataFrame([(i, j) for i, (j, _) in enumerate(cases)], "i int, j string")
    got = df.select("i", coerce_variant(F.try_parse_json("j")).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == [want for _, want in cases]
    nothing = df.select(coerce_variant(F.try_parse_json(F.lit(None).cast("string"))).alias("t")).distinct().collect()
    assert [r.t for r in nothing] == [""]


def test_read_feed_variant(spark, tmp_path):
    pages = [
        {"category": "tech", "articles": [{"title": "one", "url": "u1", "content": ["a", "b"], "publishedAt": "2025-08-10T00:00:00Z", "source": {"name": "wire"}},
                                          {"title": ["two", "more"], "url": "u2", "content": {"text": "c"}, "source": "plain"}]},
        {"articles": [{"title": None, "url": "u3", "extra": 1}, {"title": 4, "url": "u4", "content": "x" * 200_000, "source": 9}]},
        {"articles": {"title": "no list"}}, {"status": "error"}, [1, 2],
    ]
    (tmp_path / "feed.json").write_text("\n".join([json.dumps(p) for p in pages] + ["broken {", ""]))
    rows = {r.url: r for r in read_feed_variant(spark, str(tmp_path)).collect()}
    assert set(rows) == {"u1", "u2", "u3", "u4"}
    assert (rows["u1"].category, rows["u1"].title, rows["u1"].content, rows["u1"].source.name) == ("tech", "one", "a\nb", "wire")
    assert (rows["u2"].title, rows["u2"].content, rows["u2"].source.name, rows["u2"].publishedAt) == ("two\nmore", "c", "plain", None)
    assert (rows["u3"].category, rows["u3"].title, rows["u3"].content, rows["u3"].source.name) == (None, None, None, None)
    assert rows["u4"].title == "4" and len(rows["u4"].content) == 200_000 and rows["u4"].source.name is None
