"""Merged word sketches against exact counts."""

from pyspark.sql import functions as F

from newstide.operators.sketches import ERROR, merge_sketches, word_sketches


def test_error_and_totals(spark, tmp_path):
    rows = spark.range(400).select((F.col("id") % 20).cast("string").alias("sample"), F.transform(F.sequence(F.lit(0), F.lit(499)), lambda i: F.concat(F.lit("w"), (F.col("id") * 300 + i).cast("string"))).alias("nouns"))
    word_sketches(rows).write.parquet(str(tmp_path / "sketches"))
    stored = spark.read.parquet(str(tmp_path / "sketches"))
    assert stored.count() == 20
    got = merge_sketches(stored).first()
    exact = 399 * 300 + 500
    assert got.total_words == 200_000 and abs(got.distinct_estimate - exact) <= 4 * ERROR * exact
    half = merge_sketches(stored.where("sample < 10")).first()
    assert half.total_words == 100_000 and half.distinct_estimate < got.distinct_estimate


def test_nothing(spark):
    rows = spark.createDataFrame([("s", None), ("t", []), (None, ["a", "a", None])], "sample string, nouns array<string>")
    assert [tuple(r) for r in merge_sketches(word_sketches(rows), "sample").collect()] == [(None, 2, 1)]
    assert tuple(merge_sketches(word_sketches(rows.where("false"))).first()) == (0, 0)
