"""Running combinations along an order, for histories of any length.

A running sum over a window puts all rows of a key into one task, and a fold over ``collect_list`` into one row. Where the
combination is associative neither is needed: the order is cut into blocks of a fixed number of places, each block is
folded by itself, the blocks' totals are scanned the same way, and what comes before a block is combined with its own
running values. A row holds at most ``width`` elements, blocks of one key spread over tasks, and the number of levels grows
with the logarithm of the span.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.session import cut

WIDTH = 64

Combine = Callable[[Column, Column], Column]


def prefix_scan(rows: DataFrame, keys: list[str], at: str, element: Column, kind: str, combine: Combine, width: int = WIDTH) -> DataFrame:
    """(keys, at, scan): for each row the combination of all elements of its key up to and including its own.

    ``at`` is a whole number; at most one row per key and place is expected, and rows that share a place follow one another
    in the order of their elements. ``combine`` takes (earlier, later) and must be associative; ``kind`` is the type of
    the element and of the result. Rows with a null key or place are left out; an empty table gives an empty result.
    """
    names = [f"k{i}" for i in range(len(keys))]
    good = F.col(at).isNotNull()
    for k in keys:
        good = good & F.col(k).isNotNull()
    own = rows.where(good).select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(at).cast("long").alias("at"), element.cast(kind).alias("x"))
    bounds = own.agg(F.min("at").alias("low"), F.max("at").alias("high")).first()
    if bounds["low"] is None:
        scanned = own.withColumn("before", F.lit(None).cast(kind))
    else:
        scanned = _exclusive(own, names, bounds["low"], bounds["high"], kind, combine, width)
    return scanned.select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], F.col("at").alias(at), _joined(F.col("before"), F.col("x"), combine).alias("scan"))


def _joined(early: Column, late: Column, combine: Combine) -> Column:
    return F.when(early.isNull(), late).when(late.isNull(), early).otherwise(combine(early, late))


def _exclusive(rows: DataFrame, names: list[str], low: int, high: int, kind: str, combine: Combine, width: int) -> DataFrame:
    """Add ``before``, the combination of all earlier elements of the key; null for the first."""
    block = F.floor((F.col("at") - F.lit(low)) / F.lit(width)).cast("long").alias("block")
    runs = rows.groupBy(*names, block).agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("run"))
    start = F.struct(F.lit(None).cast(kind).alias("total"), F.array().cast(f"array<struct<at:bigint,x:{kind},before:{kind}>>").alias("out"))

    def step(acc: Column, r: Column) -> Column:
        seen = F.struct(r["at"].alias("at"), r["x"].alias("x"), acc["total"].alias("before"))
        return F.struct(_joined(acc["total"], r["x"], combine).alias("total"), F.array_append(acc["out"], seen).alias("out"))

    runs = runs.select(*names, "block", F.aggregate("run", start, step).alias("done"))
    if high - low < width:
        return runs.select(*names, F.inline("done.out"))
    runs = cut(runs)  # read for the totals and for the rows
    totals = runs.select(*names, F.col("block").alias("at"), F.col("done.total").alias("x"))
    above = _exclusive(totals, names, 0, (high - low) // width, kind, combine, width)
    carried = above.select(*names, F.col("at").alias("block"), F.col("before").alias("carry"))
    out = runs.join(carried, [*names, "block"]).select(*names, "carry", F.inline("done.out"))
    return out.select(*names, "at", "x", _joined(F.col("carry"), F.col("before"), combine).alias("before"))
