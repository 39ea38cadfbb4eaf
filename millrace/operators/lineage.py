"""Writing intermediate tables to the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a temporary one, but only on one machine: executors of a cluster would not see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/millrace-{label}/{uuid.uuid4().hex}"


def shared(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """The same rows, read back from a table in the shared folder."""
    spark = df.sparkSession
    path = new_folder(spark, "tables")
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
