"""The queries of these operators: each reads a whole table and derives the columns it returns from its operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import leaks
from .embeddings import near_vectors
from .html import extract
from .language import language_id
from .lines import dedup_lines
from .minhash import NearConfig, near_duplicates
from .mixing import mix_sources
from .negatives import mine
from .packing import best_fit, public_pack_config
from .suffixes import repeats
from .tables import read
from .tokens import materialise, public_config
from .toxicity import toxicity
from .whitening import whiten


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document: words, words and target of its source, words that the mix takes."""
    return mix_sources(read(spark, sf_dir, "documents")).documents.select("doc_id", "size", "source_size", "target", "taken")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each page: the text of its article."""
    return extract(read(spark, sf_dir, "pages"))


def op3_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document: size of its set of 4-word shingles, its component, and whether it is the one kept."""
    return near_duplicates(read(spark, sf_dir, "documents"), NearConfig(shingle=4))


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each sequence of token ids in training order: its slot, shard, byte, documents and checksum; the shards are files."""
    return materialise(read(spark, sf_dir, "documents"), public_config()).index


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that it holds within a fifth of the item's words in edits."""
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each stretch of 50 words or more that repeats an earlier one, with the place of the earlier."""
    return repeats(read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document: its score and prediction, learned from labels outside the held-out fold."""
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document: its predicted language, learned outside the held-out fold."""
    return language_id(read(spark, sf_dir, "documents"))


def op9_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each vector: how many others it links with at cosine 0.98 within its label, and its component."""
    return near_vectors(read(spark, sf_dir, "embeddings"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document that loses lines or sentences: what is left, and the spans that went with their kept occurrences."""
    return dedup_lines(read(spark, sf_dir, "documents"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each piece of a document: its ids' checksum, and its place in a sequence of at most 4,096 ids."""
    return best_fit(read(spark, sf_dir, "documents"), public_pack_config())


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each sound vector and component: whitened coordinate, exact squared deviation, explained share; a deviation beyond 64 bits is null."""
    rows = whiten(read(spark, sf_dir, "embeddings")).rows
    return rows.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each negative of an anchor and positive: rows of other labels in the window below the positive's score. The fold of ids divisible by 7 is relabelled."""
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = mine(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_main_text, op3_minhash_near_duplicates, op4_token_shards, op5_decontaminate, op6_suffix_dedup, op7_toxicity, op8_language_id, op9_embedding_near_duplicates, op10_line_dedup, op11_best_fit_packing, op12_embedding_whitening, op13_hard_negatives)}

ORACLE_SQL: dict[str, str] = {}
