"""Shared helpers of the corpus operators: bounded Arrow batches, labelled samples, batches as columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.session import BATCH_BYTES, BATCH_ROWS, bounded_batches, cut  # noqa: F401 (taken from here by the operators)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Run ``fn`` over the Arrow batches of every partition."""
    bounded_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; a null text counts as an empty one."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def marks_of(labels: DataFrame, label: str, usable=None) -> DataFrame:
    """(doc_id, label) of the labelled ids; a document labelled more than once counts with the mean of its labels."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if usable is not None:
        marks = marks.where(usable)
    return marks.groupBy("doc_id").agg(F.avg(label).alias("label"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, usable=None) -> DataFrame:
    """About ``rows`` labelled documents at most, as (doc_id, text, label as a share of ones).

    The sample is bounded by ``rows``, a documented parameter, and chosen by the hash of ``doc_id``, so that it does not
    depend on the order of rows or on partitions. Rows without an id, a label or a text do not take part. A document
    labelled more than once counts with the mean of its labels, one that occurs more than once with its smallest text.
    """
    marks = marks_of(labels, label, usable)
    n = marks.count()
    if n > rows:
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) < int(rows / n * (1 << 31)))
    # At most about `rows` pairs of numbers: a broadcast of proven size, which also cuts the scan before any text work.
    found = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").where(F.col("text").isNotNull())
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))


def order_statistics(values: DataFrame, name: str, most: int = 100_000) -> tuple[int, Callable[[int], float]]:
    """(number of values, function that gives the value of a rank from 0).

    The range is narrowed by histograms until few values are left, which alone reach the driver.
    """
    rows = values.groupBy(F.col(name).alias("v")).agg(F.count("*").alias("n"))  # equal values are one row
    rows = cut(rows)
    total, low, high = rows.agg(F.sum("n"), F.min("v"), F.max("v")).first()

    def at(rank: int) -> float:
        a, b, before = low, high, 0
        while True:
            inside = rows.where((F.col("v") >= a) & (F.col("v") <= b))
            width = (b - a) / 1000
            if inside.limit(most + 1).count() <= most or width <= 0 or a + width == a:
                left = inside.orderBy("v").toPandas()
                return float(left["v"].iloc[int(np.searchsorted(np.cumsum(left["n"].to_numpy()), rank - before, side="right"))])
            bins = inside.groupBy(F.floor((F.col("v") - a) / width).alias("bin")).agg(F.sum("n").alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).orderBy("bin").toPandas()
            ends = before + np.cumsum(bins["n"].to_numpy())
            k = int(np.searchsorted(ends, rank, side="right"))
            before = int(ends[k] - bins["n"].iloc[k])
            a, b = float(bins["a"].iloc[k]), float(bins["b"].iloc[k])

    return total, at


def usable_vector(vec: Column) -> Column:
    """True for a vector of at least one entry, all of them present and finite."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vec) > 0) & finite, F.lit(False))


def matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """Rows of a column of vectors without nulls, all of one length."""
    col = column(batch, name)
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it for as long as ``df`` has a column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
