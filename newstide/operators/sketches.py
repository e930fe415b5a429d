"""Words over any range of samples, from sketches stored per sample: articles are read once, when their sample is closed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.functions.text import explode_words

#: 2^14 registers: the standard error of a distinct count is 1.04 / sqrt(2^14), about 0.8 %.
PRECISION = 14
ERROR = 1.04 / 2 ** (PRECISION / 2)


def word_sketches(clean: DataFrame, *keys: str) -> DataFrame:
    """Per key (``sample`` unless given) the number of words and a mergeable sketch of the distinct ones, of fixed size."""
    keys = keys or ("sample",)
    words = explode_words(clean, F.col("nouns"), *keys)
    return words.groupBy(*keys).agg(F.count("*").alias("total_words"), F.hll_sketch_agg("word", PRECISION).alias("words"))


def merge_sketches(sketches: DataFrame, *keys: str) -> DataFrame:
    """Totals and estimated distinct words of groups of stored sketches; no article is read. Without keys one row for all."""
    merged = sketches.groupBy(*keys).agg(F.sum("total_words").alias("total_words"), F.hll_union_agg("words").alias("words"))
    return merged.select(*keys, F.coalesce("total_words", F.lit(0)).alias("total_words"), F.hll_sketch_estimate("words").alias("distinct_estimate"))
