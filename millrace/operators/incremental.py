"""Evaluation that scores only what has changed: results are kept by a fingerprint of the settings and the case.

A fingerprint is SHA-256 over the canonical JSON of the settings (model, revision, most new tokens, how text is generated) and of all fields of
the case. A case whose fingerprint is in the cache is not answered or scored again; one that changed in any field is, and so is every case
when a setting changes. A case without an output is not kept, so that it is tried again. The cache is a folder of Parquet that grows by
appending; where two runs kept the same fingerprint, the first output in order of text counts, so results do not depend on files.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.writers import json_lines
from .cases import run
from .lineage import shared

KEPT = "fingerprint string, output string, passed boolean, reason string"


def fingerprint(cases: DataFrame, settings: dict) -> Column:
    told = json.dumps(settings, sort_keys=True, ensure_ascii=False)
    return F.sha2(F.concat(F.lit(told + "\n"), json_lines(cases)), 256)


def kept(spark: SparkSession, folder: str) -> DataFrame:
    """What the cache has, a row for each fingerprint; no folder is an empty cache."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], KEPT)
    rows = spark.read.schema(KEPT).parquet(folder)
    return rows.groupBy("fingerprint").agg(F.min(F.struct("output", "passed", "reason")).alias("r")).select("fingerprint", "r.*")


@dataclass
class Evaluated:
    results: DataFrame  #: the cases with output, passed, reason, and fresh: whether this run scored them
    scored: int  #: cases that this run answered and scored


def evaluate(cases: DataFrame, answer: Callable[[DataFrame], DataFrame], settings: dict, folder: str) -> Evaluated:
    """cases as run() takes them. answer: cases to id, output; it is called once, with the cases that are not in the cache, and not at all if there are none."""
    spark = cases.sparkSession
    keyed = cases.withColumn("fingerprint", fingerprint(cases, settings))
    before = shared(kept(spark, folder))
    new = shared(keyed.join(before, "fingerprint", "left_anti"))
    n = new.count()
    told = ["fingerprint", "output", "passed", "reason"]
    if n:
        done = shared(run(new, answer(new.drop("fingerprint"))).select(*told))
        done.where("output is not null").write.mode("append").parquet(folder)
    else:
        done = before.where("false")
    every = before.select(*told, F.lit(False).alias("fresh")).union(done.distinct().select(*told, F.lit(True)))
    return Evaluated(keyed.join(every, "fingerprint", "left").drop("fingerprint"), n)
