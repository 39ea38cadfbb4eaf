"""The stateless filters and exact dedup of the build as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T
from ..operators import quality


def clean_stream(spark: SparkSession, folder: str, schema: StructType | str, config: quality.QualityConfig = quality.QualityConfig(), watermark: str = "1 day") -> DataFrame:
    """Records of new JSON files with id, text and arrived, without those that a filter rejects and without repeats inside the watermark."""
    rows = spark.readStream.schema(schema).json(folder)
    kept = rows.where(quality.repetition_reason(F.col("text"), config).isNull() & (F.length("text") >= config.min_answer_chars))
    return kept.withColumn("content", F.sha2(T.normalize(F.col("text")), 256)).withWatermark("arrived", watermark).dropDuplicatesWithinWatermark(["content"])


def run_once(stream: DataFrame, output: str, checkpoint: str) -> None:
    """Everything that is there, then stops; a later call goes on from the checkpoint."""
    stream.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
