"""Quality rules: base limits, then an isolation forest on rule statistics.

Random splits isolate unusual documents early, so a short mean path marks an anomaly. Every tree draws its rows from all
labelled rows, and the limit on the score comes from the scores of all of them; every document is then judged where it is
read, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.llm import textstats
from newstide.llm.common import bounded_batches, free_name, labelled_sample, marks_of, order_statistics
from newstide.operators.ordinals import ordinal_within
from newstide.session import stage


@dataclass(frozen=True)
class ForestConfig:
    """Up to ``sample_rows`` labelled rows are fitted on the driver, more by Spark; ``max_lost`` is the share of good ones
    that the limit may reject."""

    trees: int = 400
    rows_per_tree: int = 64
    sample_rows: int = 20_000
    max_lost: float = 0.01
    seed: int = 7


def rule_statistics(counts: np.ndarray) -> np.ndarray:
    """What the splits are drawn over: mean word length and the rates of symbols, capitals, exclamation marks, repeated
    windows and the commonest word, each as r / (r + 0.3), so that a few extreme texts do not stretch the range of splits."""
    r = textstats.ratios(counts)[:, [1, 2, 7, 12, 4, 6]]
    return r / (r + 0.3)


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows: what a leaf of n rows still hides."""
    n = np.asarray(n, float)
    harmonic = np.log(np.maximum(n - 1, 1)) + 0.5772156649
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class IsolationForest:
    """Trees in heap order: node i has the children 2i + 1 and 2i + 2; a feature of -1 marks a leaf.

    A tree draws its rows from ``rows``, unless ``drawn`` gives the positions of those of each tree.
    """

    def __init__(self, rows: np.ndarray, cfg: ForestConfig, drawn: np.ndarray | None = None):
        rng = np.random.default_rng(cfg.seed)
        size = min(cfg.rows_per_tree, len(rows)) if drawn is None else drawn.shape[1]
        self.depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
        nodes = 2 ** (self.depth + 1) - 1
        self.feature = np.full((cfg.trees, nodes), -1, np.int16)
        self.split = np.zeros((cfg.trees, nodes))
        self.path = np.zeros((cfg.trees, nodes))
        self.norm = float(_mean_path(size)) or 1.0
        for tree in range(cfg.trees):
            waiting = [(0, 0, rows[rng.choice(len(rows), size, replace=False) if drawn is None else drawn[tree]])]
            while waiting:
                node, depth, own = waiting.pop()
                low, high = own.min(0), own.max(0)
                free = np.flatnonzero(high > low)
                if depth == self.depth or not len(free):
                    self.path[tree, node] = depth + float(_mean_path(len(own)))
                    continue
                f = int(rng.choice(free))
                at = rng.uniform(low[f], high[f])
                right = own[:, f] > at
                self.feature[tree, node], self.split[tree, node] = f, at
                waiting += [(2 * node + 1, depth + 1, own[~right]), (2 * node + 2, depth + 1, own[right])]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score from 0 to 1: two to the power of minus the mean path over that of a random search."""
        total = np.zeros(len(rows))
        each = np.arange(len(rows))
        for feature, split, path in zip(self.feature, self.split, self.path, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                node = np.where(f < 0, node, 2 * node + 1 + (rows[each, f] > split[node]))
            total += path[node]
        return 2.0 ** (-total / len(self.feature) / self.norm)


@dataclass
class QualityModel:
    """``limit`` is the highest anomaly score that is kept; without a forest everything is."""

    forest: IsolationForest | None = None
    limit: float = 1.0

    def score(self, counts: np.ndarray) -> np.ndarray:
        return self.forest.score(rule_statistics(counts)) if self.forest and len(counts) else np.zeros(len(counts))


def fit(docs: DataFrame, labels: DataFrame, cfg: ForestConfig = ForestConfig()) -> QualityModel:
    """Forest of all rows with a ``quality`` label, and its limit.

    The lowest limit that rejects at most ``max_lost`` of the rows with label 1 that pass the base limits says which
    rows with label 0 can be rejected; the limit is then raised to just below the first of these. Without labelled rows,
    or without good ones, nothing is rejected.
    """
    if marks_of(labels, "quality").count() > cfg.sample_rows:
        return fit_many(stage(textstats.labelled_counts(docs, labels, "quality"), "counted"), cfg)
    sample = labelled_sample(docs, labels, "quality", cfg.sample_rows)  # all of them
    counts, label = textstats.collect(sample)
    good = label >= 0.5
    passed = ~base_failed(counts)
    if not (good & passed).any():
        return QualityModel()
    forest = IsolationForest(rule_statistics(counts[passed]), cfg)
    score = forest.score(rule_statistics(counts[passed]))
    fine = np.sort(score[good[passed]])
    limit = fine[_limit_rank(len(fine), cfg)]
    worse = score[~good[passed] & (score > limit)]
    if len(worse):  # no need to reject what lies below the first bad row
        limit = (worse.min() + score[score < worse.min()].max()) / 2
    return QualityModel(forest, float(limit))


def _limit_rank(good: int, cfg: ForestConfig) -> int:
    return good - 1 - int(cfg.max_lost * good)


def fit_many(rows: DataFrame, cfg: ForestConfig) -> QualityModel:
    """Model of (doc_id, label, counts) rows of any number; only the rows that the trees draw reach the driver."""
    counts = list(textstats.COUNTS)

    @F.pandas_udf("boolean")
    def passes(*columns: pd.Series) -> pd.Series:
        return pd.Series(~base_failed(_counts_of(columns)), dtype=bool)

    passed = stage(ordinal_within(rows.where(passes(*counts)).withColumn("whole", F.lit(0)), "whole", "doc_id"), "passed")
    good = F.col("label") >= 0.5
    n, n_good = passed.agg(F.count("*"), F.count_if(good)).first()
    if not n_good:
        return QualityModel()
    rng = np.random.default_rng(cfg.seed)
    drawn = np.stack([rng.choice(n, min(cfg.rows_per_tree, n), replace=False) for _ in range(cfg.trees)])
    places, where = np.unique(drawn, return_inverse=True)
    wanted = rows.sparkSession.createDataFrame(pd.DataFrame({"ordinal": places}), "ordinal long")
    own = passed.join(F.broadcast(wanted), "ordinal").orderBy("ordinal").select(*counts).toPandas().to_numpy(np.int64)
    model = QualityModel(IsolationForest(rule_statistics(own), cfg, where.reshape(drawn.shape)))

    @F.pandas_udf("double")
    def anomaly(*columns: pd.Series) -> pd.Series:
        return pd.Series(model.score(_counts_of(columns)))

    bounded_batches(rows.sparkSession)
    scored = stage(passed.select("label", anomaly(*counts).alias("score")), "scored")
    total, at = order_statistics(scored.where(good), "score")
    limit = at(_limit_rank(total, cfg))
    score = F.col("score")
    worse = scored.where(~good & (score > limit)).agg(F.min(score)).first()[0]
    if worse is not None:
        limit = (worse + scored.where(score < worse).agg(F.max(score)).first()[0]) / 2
    return QualityModel(model.forest, float(limit))


def _counts_of(columns) -> np.ndarray:
    return np.stack([c.to_numpy(np.int64) for c in columns], axis=1)


def base_failed(counts: np.ndarray) -> np.ndarray:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    words, repeated = counts[:, 0], counts[:, 4]
    return (words < 50) | (100 * repeated > 50 * words)


def judge(docs: DataFrame, model: QualityModel) -> DataFrame:
    """All columns of ``docs`` with the base statistics, ``base_failed``, ``anomaly`` and ``kept``.

    Columns of these names in the input are replaced. A null or empty text has no words and fails the base rules. Equal
    texts get equal verdicts; an empty table gives an empty result. ``kept`` is false for what fails the base rules, else
    it says whether the anomaly score is within the limit.
    """
    new = {**dict.fromkeys(textstats.BASE, "long"), "base_failed": "boolean", "anomaly": "double", "kept": "boolean"}
    docs = docs.drop(*new)
    bounded_batches(docs.sparkSession)

    @F.pandas_udf(", ".join(f"{c} {t}" for c, t in new.items()))
    def verdict(texts: pd.Series) -> pd.DataFrame:
        counts = textstats.table([t or "" for t in texts])
        failed, score = base_failed(counts), model.score(counts)
        base = {c: counts[:, i] for i, c in enumerate(textstats.BASE)}
        return pd.DataFrame(base | {"base_failed": failed, "anomaly": score, "kept": ~failed & (score <= model.limit)})

    out = free_name(docs, "verdict")
    return docs.withColumn(out, verdict("text")).select(*docs.columns, f"{out}.*")


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps; their columns stay as they are, whatever their names."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        counts = textstats.table([t or "" for t in texts])
        return pd.Series(~base_failed(counts) & (model.score(counts) <= model.limit), dtype=bool)

    return docs.where(kept("text"))
