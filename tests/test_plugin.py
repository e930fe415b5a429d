"""A plugged-in source over landed files, in batches and as a stream that is restarted."""

import json

import pytest
from newstide.sources import plugin
from newstide.streaming.intake import run_available


def entries(file):
    """A scraper of its own: one row per line, the url before the first bar."""
    for line in file:
        url, _, title = line.decode().rstrip("\n").partition("|")
        yield {"url": url, "title": title, "source": "wire", "unknown": 1}


def rows(df):
    return sorted((r.url, r.title, r.source, r.text) for r in df.collect())


def test_batch_and_stream(spark, tmp_path):
    plugin.register(spark)
    landing, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    (landing / "deep").mkdir(parents=True)
    (landing / "a.txt").write_text("u1|one\nu2|two\n")
    (landing / "deep" / "b.txt").write_text("u3|thrée\n")
    (landing / "_writing.txt").write_text("u9|no\n")
    (landing / "empty.txt").write_text("")
    options = {"path": str(landing), "scraper": "test_plugin:entries"}
    first = [("u1", "one", "wire", None), ("u2", "two", "wire", None), ("u3", "thrée", "wire", None)]
    assert rows(spark.read.format("newstide_files").options(**options).load()) == first
    stream = lambda: spark.readStream.format("newstide_files").options(**options).load()
    run_available(stream(), out, state)
    landed = lambda: rows(spark.read.schema(plugin.SCHEMA).parquet(out))
    assert landed() == first
    run_available(stream(), out, state)
    assert landed() == first
    (landing / "c.txt").write_text("u4|four\n")
    run_available(stream(), out, state)
    assert landed() == first + [("u4", "four", "wire", None)] == rows(spark.read.format("newstide_files").options(**options).load())


def test_lines_schema_and_empty(spark, tmp_path):
    plugin.register(spark)
    read = lambda: spark.read.format("newstide_files").option("path", str(tmp_path / "in")).schema("url string, n long").load()
    assert read().count() == 0
    (tmp_path / "in").mkdir()
    assert read().count() == 0
    (tmp_path / "in" / "x.json").write_text(json.dumps({"url": "u" * 100_000, "n": 5}) + "\n\n" + json.dumps({"n": None}))
    assert sorted((len(r.url or ""), r.n) for r in read().collect()) == [(0, None), (100_000, 5)]
    (tmp_path / "in" / "y.json").write_text("broken")
    with pytest.raises(Exception, match="JSONDecodeError"):
        read().count()


def test_groups():
    files = [(i, f"f{i}", size) for i, size in enumerate([10, 10, 100, 5, 5, 5])]
    assert [g.paths for g in plugin.grouped(files, 20)] == [("f0", "f1"), ("f2",), ("f3", "f4", "f5")]
    assert plugin.grouped([], 20) == []
