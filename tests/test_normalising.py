"""Normalising and telling languages: what they cost beside one search of the text, and the quick ways against plain ones."""

import time

from pyspark.sql import functions as F

from millrace.functions import text as T


def seconds(rows, column):
    took = []
    for _ in range(4):
        start = time.time()
        rows.select(column.alias("v")).agg(F.max(F.length("v"))).collect()
        took.append(time.time() - start)
    return min(took)


def test_normalising_costs_less_than_two_searches_for_white_space(spark):
    """Telling by patterns which texts the Unicode library is needed for took longer than the library takes for all."""
    rows = spark.range(600).select(F.repeat(F.lit("Der schöne Garten liegt hinter dem alten Haus.\n"), 400).alias("t")).cache()
    rows.count()
    assert seconds(rows, T.normalize(F.col("t"))) < 2 * seconds(rows, F.trim(F.regexp_replace("t", T._UNEVEN, " ")))


def test_latin_letters_are_counted_once(spark):
    """Language by the shares that the rule names, each counted by itself, also where letters and Latin characters differ."""
    parts = ["the garden of an old house ", "жизнь и сад ", "ⅷ Ⅳ ⅷⅷ ", "ªº ", "người bạn của tôi ", "khong phai cua ban ", "中文字 ", "12 34 ", "école où "]
    rows = spark.createDataFrame([(a * i + b * j + c,) for a in parts for b in parts for c in parts for i, j in ((3, 1), (1, 4))] + [(None,)], "t string")
    low = F.lower(F.coalesce("t", F.lit("")))
    letters, latin = T.count_class(low, r"\p{L}"), T.count_class(low, r"\p{IsLatin}a-z")
    early = F.when(letters < 20, "unknown").when(latin * 10 < letters * 7, "other").when(T.count_letters(low, T.VIETNAMESE_LETTERS) * 20 >= latin, "vi")
    got = rows.select(T.detect_language(F.col("t")).alias("found"), early.alias("early"))
    assert got.where("early is not null and early <> found or early is null and found not in ('en', 'vi-khong-dau', 'unknown')").count() == 0
    assert got.select("found").distinct().count() == 5
