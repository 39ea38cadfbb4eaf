"""From raw documents to token ids in training order: five stages, each one operator of millrace.llm.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. run() writes every stage's result
as Parquet in the shared folder and reads it again for the next, so a lost executor never costs more than a stage's own
work. Each stage keeps the session's batches for Python small, whoever writes its result. SQL cannot express the stages; tests hold each against a brute-force version on a small fixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.decontaminate import clean
from millrace.llm.language import fit_language
from millrace.llm.minhash import deduplicated
from millrace.llm.mixing import mixed_documents
from millrace.llm.tables import read, settled, written
from millrace.llm.tokens import materialise, public_config

#: A document whose most likely language has less than this chance is in none of them.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; texts without a letter, null ones too, and texts of no clear language go."""
    settled(spark)
    return fit_language(docs).known(docs, LEAST_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id; of rows that repeat an id and its text one, and all rows without an id."""
    settled(spark)
    return deduplicated(docs).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    settled(spark)
    return clean(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row for each document and pass over its source, with the taken part of its text."""
    settled(spark)
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the shards: a row for each sequence, with its slot, shard, byte and documents."""
    settled(spark)
    return materialise(docs, public_config()).index


STAGES = [("language ID", language), ("MinHash near-dedup", near_dedup), ("benchmark decontamination", decontaminate), ("mixing sources to target weights", mix), ("token-ID / binary output", tokens)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
