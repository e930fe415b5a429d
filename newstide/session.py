"""Session helpers: builder, UTC, shared scratch space and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch handed to a Python task.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def build_session(app: str = "newstide", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Lets the adaptive planner hash-join partitions it has seen to be small, instead of sorting them.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it gets a temporary folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="newstide-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget how it was made."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough that very long texts fit beside the Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Redistribute a small file that arrives in fewer splits than the cluster has cores.

    Text work is bound by the processor, and a few row groups would keep most cores idle.
    Large inputs have more splits than cores and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < 2 * cores else df


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only after counting that ``df`` stays under ``max_rows``."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def side_by_side(*frames: DataFrame) -> DataFrame:
    """Put one-row frames with different columns into one row, without a join."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def stage(df: DataFrame, name: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    For large results that several branches read: unlike a checkpoint it is columnar,
    so each branch reads only its columns. ``options`` are those of the Parquet writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
