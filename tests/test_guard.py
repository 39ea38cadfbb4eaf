"""The guard of training rows and cases: no false negatives, few rows to the joins, and the reference's reasons."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import guard

KIND = "id string, content string, questions array<string>"


@pytest.mark.parametrize("config", [guard.BloomConfig(), guard.BloomConfig(words=8, hashes=3), guard.BloomConfig(words=1, hashes=1)])
def test_no_false_negatives(spark, config):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    some = guard.bloom(keys.union(spark.createDataFrame([(None,)], "key string")), config)
    assert some.count() == 1 and some.select(F.size("bloom")).first()[0] == config.words
    held = lambda rows: rows.crossJoin(some).select(F.count_if(guard.may_hold(F.col("bloom"), F.col("key"), config))).first()[0]
    assert held(keys) == 3000
    others = held(spark.range(20000).select(F.concat(F.lit("other"), "id").alias("key")))
    assert others < 40 if config.words > 1000 else True
    assert held(spark.createDataFrame([(None,)] * 5, "key string")) == 0
    nothing = guard.bloom(keys.where("false"), config)
    assert keys.crossJoin(nothing).where(guard.may_hold(F.col("bloom"), F.col("key"), config)).count() == 0


def test_reasons_and_the_error(spark):
    cases = spark.createDataFrame([("c1", "h1", ["what is it", "who"]), ("c2", None, []), (None, "h3", None), ("7", "h7", ["when"])], KIND)
    rows = [("c1", "h1", ["who"]), ("t2", "h1", ["when"]), ("t3", "x", ["no", "who"]), ("t4", None, None), (None, "y", ["when"]), ("t6", "z", [None, "nothing"]), ("t7", "h3", []), ("7", "q", []), ("t8", "c1", ["h1", "id:c1"])]
    train = spark.createDataFrame(rows, KIND)
    for config in (guard.BloomConfig(), guard.BloomConfig(words=1, hashes=1)):
        got = {r["id"]: r["reason"] for r in guard.overlap(train, cases, config).collect()}
        assert got == {"c1": "id", "t2": "content", "t3": "question", "t7": "content", "7": "id", None: "question"}
    with pytest.raises(guard.TrainOverlap, match=r"6 training rows.*7 \(id\)"):
        guard.keep_apart(train, cases)
    guard.keep_apart(train.where("id in ('t4', 't6', 't8')"), cases)
    guard.keep_apart(train, cases.where("false"))
    guard.keep_apart(train.where("false"), cases)
