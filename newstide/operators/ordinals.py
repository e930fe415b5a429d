"""Consecutive numbers within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newstide.session import cut


def ordinal_within(df: DataFrame, group: str, order: str, name: str = "ordinal") -> DataFrame:
    """Number the rows of each group from 0 by ``order``, whose values must be unique per group.

    Rows are range-partitioned by (group, order) and numbered per range, then shifted
    by the sizes of the group's earlier ranges, so a large group spans many tasks.
    """
    ranged = cut(df.repartitionByRange(group, order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy(group, "_range").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    inside = Window.partitionBy(group, "_range").orderBy(order)
    numbered = ranged.withColumn("_i", F.row_number().over(inside) - 1)
    joined = numbered.join(shift, [group, "_range"])
    return joined.withColumn(name, (F.col("_i") + F.col("_shift")).cast("long")).drop("_range", "_i", "_shift")
