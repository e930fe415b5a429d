"""Fit of the pairwise ranking over all labelled rows, in blocks."""

import numpy as np
import pytest

from newstide.llm import pairrank, textstats


def corpus(spark, n=240):
    rng = np.random.default_rng(4)
    words = ["alpha", "beta", "gamma", "delta", "of", "the"]
    rows = [(i, " ".join(rng.choice(words, 60)) + (" | " + "spam spam spam " * int(rng.integers(1, 6)) if i % 3 == 0 else "."), int(i % 3 != 0)) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_every_labelled_row_counts(spark):
    rows = corpus(spark)
    docs, labels = rows.select("doc_id", "text"), rows.select("doc_id", "quality")
    counts, label = textstats.collect(rows.selectExpr("doc_id", "text", "cast(quality as double) label"))
    cfg = pairrank.RankConfig(sample_rows=60)
    model = pairrank.fit(docs, labels, cfg)
    x = pairrank.features(counts)
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, np.maximum(x.std(0), 1e-9))
    assert abs(model.limit - np.quantile(model.raw(counts), (label < 0.5).mean())) < 1e-9
    assert ((model.score(counts) >= model.threshold) == (label > 0.5)).mean() > 0.97


def test_one_block_is_the_fit_in_memory(spark):
    rows = corpus(spark, 90)
    labelled = rows.selectExpr("doc_id", "text", "cast(quality as double) label")
    want = pairrank.fit_pairs(*textstats.collect(labelled), pairrank.RankConfig())
    got = pairrank.fit_blocks(textstats.counted(labelled), 90, pairrank.RankConfig())
    assert np.allclose(got.weights, want.weights, atol=1e-5) and abs(got.limit - want.limit) < 1e-5


def test_texts_of_the_fit_are_counted_where_they_lie(spark, monkeypatch):
    rows = corpus(spark, 90)
    more = spark.createDataFrame([(3, "a b"), (4, "zz"), (None, "x"), (500, "no label"), (5, None)], "doc_id long, text string")
    docs, labels = rows.select("doc_id", "text").unionByName(more), rows.select("doc_id", "quality")
    plans, real = [], textstats.counted
    monkeypatch.setattr(textstats, "counted", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    got = {r.doc_id: r for r in textstats.labelled_counts(docs, labels, "quality", ~labels.doc_id.eqNullSafe(7)).collect()}
    assert "Exchange" not in plans[0]
    assert set(got) == set(range(90)) - {7} and got[3].n_words == 2 and got[4].n_words == 60 and got[3].label == 0.0


@pytest.mark.parametrize("share", [0.0, 0.37, 1.0])
def test_exact_quantile_with_ties(spark, share):
    values = np.concatenate([np.random.default_rng(1).normal(size=300), np.full(200, 0.25), [1e6]])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert abs(pairrank.exact_quantile(df, "v", share, most=20) - np.quantile(values, share)) < 1e-9
