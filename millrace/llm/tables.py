"""Reading the input tables, and cutting lineage with tables in the shared checkpoint folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; it is deleted when the driver's Python ends."""
    path = f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


#: Bytes of the batches that Spark sends to Python while tables are written; several of them are held on either side at once.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession):
    """While this holds, batches of long texts have few rows."""
    held = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, held)


def settled(spark: SparkSession) -> None:
    """Small batches for the rest of the session, for a program whose results are written by others."""
    spark.conf.set(_BATCH, str(BATCH_BYTES))


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows, read back from a Parquet table in the shared folder: lineage ends here, and a lost executor costs only its own reads."""
    spark = df.sparkSession
    path = new_path(spark, label)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch():
    """Deletes the tables that are made while this holds, but for the last of them, once all is done; nothing that is read later may need the others."""
    start = len(_made)
    yield
    for spark, path in _made[start:-1]:
        delete(spark, path)
    del _made[start:-1]


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            delete(spark, path)
        except Exception:  # the session has ended; the cluster's own cleaning of that folder remains
            return
