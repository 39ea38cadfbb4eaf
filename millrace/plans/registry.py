"""Registers queries: a function of the tables, and DuckDB SQL for the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes that are worth a core of their own when they are text to be cut up.
SPLIT_BYTES = 32 << 20


def spread(df: DataFrame) -> DataFrame:
    """A table over all cores: a file of one row group is one task, however many cores wait. Small tables of fewer files than cores are dealt out; tables of SPLIT_BYTES a core and more only where one task would read more than twice a core's share of the rows, which the counts in the files' footers tell."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < cores * SPLIT_BYTES:
        return df if len(df.inputFiles()) >= cores else df.repartition(cores)
    rows = df.groupBy(F.spark_partition_id()).count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    if (rows["most"] or 0) * cores <= 2 * (rows["all"] or 0):
        return df
    return df.repartition(max(cores, -(-size // SPLIT_BYTES)), "doc_id")


class Tables:
    """The tables of a folder, as attributes. Texts are spread."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return spread(table) if name == "documents" else table


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add
