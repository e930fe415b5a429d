"""Quality classifier by pairwise ranking: a Bradley-Terry model on statistics of the text.

A document labelled 1 is preferred to one labelled 0. Weights minimise the logistic loss on feature differences of such
pairs, so a score is the log-odds of being preferred. The limit between the classes is a quantile of the scores of the
labelled rows: the share of rows labelled 0.

All labelled rows take part. They are dealt by a hash of ``doc_id`` into blocks of bounded size; pairs are formed inside
a block, and Spark adds up what the blocks say of each Newton step. Only sums and the quantile reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.llm import textstats
from newstide.llm.common import labelled_sample, marks_of, order_statistics
from newstide.session import bounded_batches, stage


@dataclass(frozen=True)
class RankConfig:
    """``sample_rows`` bounds the labelled rows of a block, ``pairs`` the preference pairs drawn from each block."""

    sample_rows: int = 20_000
    pairs: int = 100_000
    ridge: float = 1.0
    steps: int = 25
    threshold: float = 0.7
    seed: int = 11


def features(counts: np.ndarray) -> np.ndarray:
    """Ratios, their square roots, which tell little from none, and whether there is any."""
    r = textstats.ratios(counts)
    rates = r[:, 2:]
    n = np.maximum(counts[:, :1], 1)
    return np.concatenate([r, np.sqrt(np.maximum(rates, 0)), rates * n / (rates * n + 3), np.expm1(-n / 50)], axis=1)


@dataclass
class RankModel:
    """``score`` is the probability of being preferred to a document at the limit, shifted so that the limit is ``threshold``."""

    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    limit: float = 0.0
    threshold: float = 0.7

    def raw(self, counts: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(counts))
        return np.clip((features(counts) - self.mean) / self.scale, -6, 6) @ self.weights

    def score(self, counts: np.ndarray) -> np.ndarray:
        odds = np.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip(self.raw(counts) - self.limit + odds, -30, 30)))


def fit_pairs(counts: np.ndarray, label: np.ndarray, cfg: RankConfig) -> RankModel:
    """Model from counts and labels; without rows of both labels every document scores alike, at the threshold."""
    good, bad = np.flatnonzero(label > 0.5), np.flatnonzero(label < 0.5)
    if not len(good) or not len(bad):
        return RankModel(threshold=cfg.threshold)
    x = features(counts)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    x = np.clip((x - mean) / scale, -6, 6)
    d = _differences(x, good, bad, cfg)
    w = newton(lambda w: _sums(d, w), d.shape[1], cfg)
    return RankModel(mean, scale, w, float(np.quantile(x @ w, len(bad) / (len(good) + len(bad)))), cfg.threshold)


def _differences(x: np.ndarray, good: np.ndarray, bad: np.ndarray, cfg: RankConfig) -> np.ndarray:
    """Feature differences of pairs; every row of the block takes part about equally often."""
    rng = np.random.default_rng(cfg.seed)
    n = max(min(cfg.pairs, len(good) * len(bad)), len(good), len(bad))
    first = np.concatenate([rng.permutation(good) for _ in range(-(-n // len(good)))])[:n]
    second = np.concatenate([rng.permutation(bad) for _ in range(-(-n // len(bad)))])[:n]
    return x[first] - x[second]


def _sums(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What pairs add to the gradient and to the Hessian."""
    p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
    return d.T @ p, (d * (p * (1 - p))[:, None]).T @ d


def newton(sums, width: int, cfg: RankConfig, start: np.ndarray | None = None) -> np.ndarray:
    """Weights by Newton's method over sums of pairs. The loss is convex, so the start only saves steps."""
    w = np.zeros(width) if start is None else start
    for _ in range(cfg.steps):
        gradient, hessian = sums(w)
        step = np.linalg.solve(hessian + (cfg.ridge + 1e-6) * np.eye(width), gradient - cfg.ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _added(rows: DataFrame, by: str | None, fn) -> np.ndarray:
    """The sum of ``fn(counts, label)``, an array, over blocks of rows (``by``) or over batches; added up by Spark."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        out = fn(pdf[list(textstats.COUNTS)].to_numpy(np.int64), pdf["label"].to_numpy(float))
        return pd.DataFrame({"pos": np.arange(out.size), "x": out.ravel()})

    def block(key, pdf):
        return one(pdf.sort_values("doc_id"))

    def batch(pdfs):
        for pdf in pdfs:
            yield one(pdf)

    parts = rows.groupBy(by).applyInPandas(block, "pos long, x double") if by else rows.mapInPandas(batch, "pos long, x double")
    return parts.groupBy("pos").agg(F.sum("x").alias("x")).orderBy("pos").toPandas()["x"].to_numpy()


def exact_quantile(values: DataFrame, name: str, share: float, most: int = 100_000) -> float:
    """As ``np.quantile``, exact and without bringing the values together."""
    total, at = order_statistics(values, name, most)
    place = share * (total - 1)
    floor = int(np.floor(place))
    first = at(floor)
    return first if place == floor else first + (place - floor) * (at(floor + 1) - first)


def fit_blocks(rows: DataFrame, n: int, cfg: RankConfig) -> RankModel:
    """Model of (doc_id, label, counts) rows, ``n`` of them, in as many blocks as they ask for."""
    blocks = -(-n // cfg.sample_rows)
    rows = stage(rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks))), "labelled")
    n_good, n_bad = rows.agg(F.count_if(F.col("label") > 0.5), F.count_if(F.col("label") < 0.5)).first()
    if not n_good or not n_bad:
        return RankModel(threshold=cfg.threshold)
    bounded_batches(rows.sparkSession)
    mean = _added(rows, None, lambda c, y: features(c).sum(0)) / n
    scale = np.maximum(np.sqrt(_added(rows, None, lambda c, y: ((features(c) - mean) ** 2).sum(0)) / n), 1e-9)
    width = len(mean)

    def pairs_of(counts, label):
        good, bad = np.flatnonzero(label > 0.5), np.flatnonzero(label < 0.5)
        if not len(good) or not len(bad):
            return np.zeros((0, width))
        return _differences(np.clip((features(counts) - mean) / scale, -6, 6), good, bad, cfg)

    def sums(w):
        both = _added(rows, "block", lambda counts, label: np.concatenate([a.ravel() for a in _sums(pairs_of(counts, label), w)]))
        return both[:width], both[width:].reshape(width, width)

    # The first block alone gives weights to start from, so that few steps pass over all rows.
    one = rows.where("block = 0").orderBy("doc_id").toPandas()
    d = pairs_of(one[list(textstats.COUNTS)].to_numpy(np.int64), one["label"].to_numpy(float))
    start = newton(lambda w: _sums(d, w), width, replace(cfg, ridge=cfg.ridge / blocks)) if len(d) else None
    model = RankModel(mean, scale, newton(sums, width, cfg, start), 0.0, cfg.threshold)

    @F.pandas_udf("double")
    def raw(*columns: pd.Series) -> pd.Series:
        return pd.Series(model.raw(np.stack([c.to_numpy(np.int64) for c in columns], axis=1)))

    model.limit = exact_quantile(rows.select(raw(*textstats.COUNTS).alias("raw")), "raw", n_bad / (n_good + n_bad))
    return model


def fit(docs: DataFrame, labels: DataFrame, cfg: RankConfig = RankConfig(), usable=None) -> RankModel:
    """Model of all rows with a ``quality`` label that ``usable`` allows."""
    if marks_of(labels, "quality", usable).count() <= cfg.sample_rows:  # one block, whose counts the driver can hold
        return fit_pairs(*textstats.collect(labelled_sample(docs, labels, "quality", cfg.sample_rows, usable)), cfg)
    rows = stage(textstats.labelled_counts(docs, labels, "quality", usable), "counted")
    return fit_blocks(rows, rows.count(), cfg)


def score_quality(docs: DataFrame, model: RankModel) -> DataFrame:
    """All columns of ``docs``, ``score`` from 0 to 1 and ``predicted`` (1 from the threshold on).

    Columns of these names in the input are replaced. Only the text counts; a null text scores as an empty one, which has a
    score like any other. Equal texts score alike; an empty table gives an empty result.
    """
    docs = docs.drop("score", "predicted")
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(textstats.table([t or "" for t in texts])))

    rows = docs.withColumn("score", score("text"))
    return rows.withColumn("predicted", (F.col("score") >= model.threshold).cast("int"))
