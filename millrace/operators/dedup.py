"""Exact dedup: the first of each content in order of id is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exact_dedup(df: DataFrame, key: str, content: str) -> DataFrame:
    """df with duplicate_of: the id that is kept of this content, null for that row. Contents are grouped with a map-side minimum, so a content of a third of all rows is one small group; null is a content like any other."""
    first = df.groupBy(F.col(content).alias("_content")).agg(F.min(key).alias("_kept"))
    joined = df.join(first, F.col(content).eqNullSafe(F.col("_content")))
    return joined.withColumn("duplicate_of", F.when(F.col(key) != F.col("_kept"), F.col("_kept"))).drop("_content", "_kept")
