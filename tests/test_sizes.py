"""Queries against their SQL on records over the size limit, and texts whose folding and white space are told apart quickly."""

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.plans.catalogue import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("large")
    texts = ["short", "é" * 16_700, "x" * 99_900, "x" * 99_800, "\"" * 50_000, "\U0001d11e" * 9_000, "y" * 200_000]
    rows = [(i + 20 * k, t, "en", "web") for k in range(3) for i, t in enumerate(texts, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(str(folder / "documents.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", ["validate_errors", "validate_defaults", "validate_too_large"])
def test_records_over_the_limit(spark, large, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{large}/documents.parquet/*.parquet')")
    wanted = sorted(map(repr, db.sql(ORACLE_SQL[name]).fetchall()))
    assert wanted and sorted(repr(tuple(r)) for r in QUERIES[name](spark, large).collect()) == wanted


def texts(seed):
    rng = random.Random(seed)
    parts = ["a", "Straße", "ÉCOLE", "Σ", "жизнь", "中文", "かな", "é", "ﬁ", "İ", "…", "—", "µ", ".", "!", "。", " ", "  ", "\n", "\n\n", "\t", "\r", " ", " ", "\x85", "\x1c", "a a", "the the the", "x1 x1", "9 9"]
    return ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 40))) for _ in range(600)]


def test_quick_ways_equal_plain_ones(spark):
    assert all(re.match(f"[{T.PLAIN}]", c) for c in map(chr, range(0x10000)) if any(re.match(f"[{s}]", c) for s in T._SCRIPTS))
    rows = spark.createDataFrame([(t,) for t in texts(3)], "t string")
    c = F.col("t")
    plain = F.trim(F.regexp_replace(c, T.SPACE, " "))
    cut = F.filter(F.transform(F.split(F.regexp_replace(c, r"([.!?。])\s+", "$1\n"), r"\n+"), lambda s: F.trim(F.regexp_replace(s, T.SPACE, " "))), lambda s: s != "")
    got = rows.select((T._beyond(c) == c.rlike(T._BEYOND)).alias("beyond"), (T.collapse(c) == plain).alias("collapse"), (T.sentences(c) == cut).alias("sentences"), (T.sentences(T.fold(c)) == F.transform(cut, T.fold)).alias("fold"))
    assert got.where("not (beyond and collapse and sentences and fold)").count() == 0

    def longest(words):
        best = run = 0
        for i, w in enumerate(words):
            real = sum(x.isalpha() for x in w) >= 2
            run = 0 if not real else run + 1 if i and words[i - 1] == w and run else 1
            best = max(best, run)
        return best

    for r in rows.select(T.words(c).alias("w"), T.longest_word_run(T.words(c)).alias("n")).collect():
        assert r.n == longest(r.w), r.w


def test_plain_texts_are_not_tried_against_every_range(spark):
    """The test of a range for every character of every text was nine tenths of normalising."""
    import time

    rows = spark.range(400).select(F.repeat(F.lit("Der schöne Garten liegt hinter dem alten Haus. "), 400).alias("t")).cache()
    rows.count()
    took = []
    for column in (T._beyond(F.col("t")), F.col("t").rlike(T._BEYOND)) * 2:
        start = time.time()
        rows.select(column.alias("v")).groupBy("v").count().collect()
        took.append(time.time() - start)
    assert took[2] < took[3] / 2
