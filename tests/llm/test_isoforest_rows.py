"""The isolation forest over all labelled rows, beyond what the driver fits alone."""

import numpy as np

from newstide.llm import isoforest, textstats


def corpus(spark, n):
    rng = np.random.default_rng(4)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "omega", "sigma", "iota", "kappa"]
    rows = [(i, " ".join(rng.choice(words, 40 if i % 11 == 0 else 90)) + ("" if i % 3 else " ## !! $$" * int(rng.integers(2, 30))), int(i % 3 != 0)) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_every_labelled_row_counts(spark):
    rows = corpus(spark, 300)
    docs, labels = rows.select("doc_id", "text"), rows.select("doc_id", "quality")
    cfg = isoforest.ForestConfig(trees=30, rows_per_tree=16, sample_rows=40, max_lost=0.05)
    model = isoforest.fit(docs, labels, cfg)
    counts, label = textstats.collect(rows.selectExpr("doc_id", "text", "cast(quality as double) label"))
    passed = ~isoforest.base_failed(counts)
    x, good = isoforest.rule_statistics(counts[passed]), label[passed] >= 0.5
    # the trees draw from all rows that pass, in the order of ids ...
    rng = np.random.default_rng(cfg.seed)
    drawn = np.stack([rng.choice(len(x), cfg.rows_per_tree, replace=False) for _ in range(cfg.trees)])
    forest = isoforest.IsolationForest(x, cfg, drawn)
    assert np.array_equal(model.forest.split, forest.split) and np.array_equal(model.forest.path, forest.path)
    # ... and the limit comes from the scores of all of them
    score = forest.score(x)
    fine = np.sort(score[good])
    limit = fine[len(fine) - 1 - int(cfg.max_lost * len(fine))]
    worse = score[~good & (score > limit)]
    if len(worse):
        limit = (worse.min() + score[score < worse.min()].max()) / 2
    assert model.limit == limit


def test_many_rows_without_good_ones_reject_nothing(spark):
    rows = corpus(spark, 60).selectExpr("doc_id", "text", "0 quality")
    model = isoforest.fit(rows.select("doc_id", "text"), rows.select("doc_id", "quality"), isoforest.ForestConfig(sample_rows=20))
    assert model.forest is None and model.limit == 1.0
