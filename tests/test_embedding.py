"""Text vectors and the batches that reach Python tasks."""

import numpy as np
from pyspark.sql import functions as F

from newstide.operators import models as MD
from newstide.session import BATCH_ROWS


def test_words_are_no_rows_of_a_shuffle(spark):
    """The rows of every shuffle of ``embed_text`` are articles, not words; parts of one article make one vector."""
    texts = [(1, "ab cd ab"), (1, "cd ef"), (2, None), (3, "ab " * 500), (None, "ef gh"), (None, "gh"), (4, "")]
    rows = spark.createDataFrame(texts, "article_id long, text string").withColumn("summary", F.lit(None).cast("string"))
    idf = MD.fit_idf(rows, hashed=MD.portable_hash)
    out = MD.embed_text(rows, idf, hashed=MD.portable_hash)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan and "Join" not in plan
    weight = {r.slot: r.idf for r in idf.collect()}
    slot = {w: spark.range(1).select(F.pmod(MD.portable_hash(F.lit(w)), F.lit(MD.DIMENSIONS))).first()[0] for w in ("ab", "cd", "ef", "gh")}
    assert abs(weight[slot["ab"]] - (np.log(8 / 3) + 1)) < 1e-12  # two articles of seven rows
    got = {r.article_id: dict(zip(r.vec["indices"], r.vec["values"])) for r in out.collect()}
    assert set(got) == {1, 3, None}
    for key, tf in {1: {"ab": 2, "cd": 2, "ef": 1}, 3: {"ab": 500}, None: {"ef": 1, "gh": 2}}.items():
        x = {slot[w]: n * weight[slot[w]] for w, n in tf.items()}
        size = np.sqrt(sum(v * v for v in x.values()))
        assert got[key].keys() == x.keys() and all(abs(got[key][s] - x[s] / size) < 1e-8 for s in x)
    assert [r.vec["indices"] == sorted(r.vec["indices"]) for r in out.collect()] == [True] * 3


def test_summaries_take_small_batches(spark):
    """A Python task holds a bounded number of texts at a time, whatever the table."""
    rows = spark.range(10).select(F.col("id").alias("article_id"), F.lit("short text").alias("text"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    MD.classify(rows, spark.createDataFrame([("short", "t", 1.0)], "word string, topic string, weight double"),
                spark.createDataFrame([("short", 1.0)], "word string, polarity double"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == BATCH_ROWS
