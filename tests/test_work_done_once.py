"""Texts are normalised once for a query, on all cores, and runs of words are not copied from arrays."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.plans import query_dedup, registry
from millrace.plans.catalogue import QUERIES


@pytest.fixture
def folder(spark, tmp_path):
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("Text "), F.sha2((F.col("id") % 300).cast("string"), 512)).alias("text"), F.lit("en").alias("lang"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(8).select(F.col("id").alias("item_id"), F.concat(F.lit("Question "), "id").alias("text")).write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_a_large_file_of_one_row_group_is_dealt_out(spark, folder, monkeypatch):
    monkeypatch.setattr(registry, "SPLIT_BYTES", 1 << 12)
    docs = registry.Tables(spark, folder).documents
    assert docs.groupBy(F.spark_partition_id()).count().count() >= 4
    assert docs.select("doc_id").distinct().count() == docs.count() == 400


def test_dedup_hashes_once(spark, folder):
    for name in ("dedup_exact", "dedup_rejected"):
        found = QUERIES[name](spark, folder)
        assert "foldCase" not in found._jdf.queryExecution().optimizedPlan().toString()
        assert found.count() == {"dedup_exact": 300, "dedup_rejected": 100}[name]


def test_overlap_normalises_training_rows_once(spark, folder):
    train, _ = query_dedup.overlap_sides(registry.Tables(spark, folder))
    assert "foldCase" not in train._jdf.queryExecution().optimizedPlan().toString()
    for name in ("decon_exact_overlap", "decon_guard"):
        assert sorted(tuple(r) for r in QUERIES[name](spark, folder).collect()) == [(1000000 + i, "content" if i % 4 == 0 else "question") for i in (0, 1, 4, 5)]


def test_runs_of_words_are_not_copied_from_arrays(spark):
    """Slices and an aggregate over every word took most of the time of repetition."""
    rows = spark.createDataFrame([("a b c d e f a b c d e",), ("𐌰𐌱 𐌰𐌱 é x x x x zz zz",), ("one two",), ("",)], "t string").select(T.words(F.col("t")).alias("w")).cache()
    columns = rows.select(T.ngrams(F.col("w"), 5).alias("g"), T.longest_word_run(F.col("w")).alias("n"))
    assert not {"slice(", "aggregate("} & {f for f in ("slice(", "aggregate(") if f in columns._jdf.queryExecution().optimizedPlan().toString()}
    for w, r in zip([r.w for r in rows.collect()], columns.collect()):
        assert r.g == [" ".join(w[i : i + 5]) for i in range(len(w) - 4)]
    assert [r.n for r in columns.collect()] == [0, 2, 1, 0]
