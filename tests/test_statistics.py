"""Statistics that add up: counts are exact, the median within its bound, and a build that is done again replaces its own."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import statistics

SCHEMA = "build string, source string, n bigint, score double"


def rows(seed, count):
    """A hot source, ties, lengths of all sizes, nulls in every column."""
    r = random.Random(seed)
    pick = lambda: int(10 ** r.uniform(0, 6)) if r.random() > 0.3 else 100
    return [(f"b{r.randrange(3)}", r.choice(["hot", "hot", "cold", None]), None if r.random() < 0.05 else pick(), None if r.random() < 0.5 else r.randrange(101) / 100) for _ in range(count)]


def of(df):
    return statistics.summary(df, "build", "source", length=F.col("n"), score=F.col("score"))


def test_merged_equals_whole(spark):
    data = rows(1, 20000)
    df = spark.createDataFrame(data, SCHEMA)
    parts = [of(df.where(F.col("build") == b)) for b in ("b0", "b1", "b2")]
    found = {r.source: r for r in statistics.told(statistics.merge(parts[0].unionByName(parts[1]).unionByName(parts[2]), "source")).collect()}
    assert set(found) == {"hot", "cold", None}
    for source, r in found.items():
        mine = [d for d in data if d[1] == source]
        lengths, scores = sorted(d[2] for d in mine if d[2] is not None), [d[3] for d in mine if d[3] is not None]
        assert (r.examples, r.characters, r.longest, r.scored) == (len(mine), sum(lengths), lengths[-1], len(scores))
        assert r.mean == sum(lengths) / len(lengths) and abs(r.quality - sum(scores) / len(scores)) < 1e-9
        below, upto = sum(x < r.median for x in lengths) / len(lengths), sum(x <= r.median for x in lengths) / len(lengths)
        assert below <= 0.5 + statistics.RANK_ERROR and upto >= 0.5 - statistics.RANK_ERROR


def test_few_lengths_are_exact_and_none_are_null(spark):
    df = spark.createDataFrame([("b", "one", n, None) for n in (1, 2, 3, 4, 100)] + [("b", "none", None, 0.5)], SCHEMA)
    found = {r.source: r for r in statistics.told(statistics.merge(of(df), "source")).collect()}
    assert found["one"].median == 3 and found["one"].quality is None
    assert (found["none"].examples, found["none"].characters, found["none"].longest, found["none"].mean, found["none"].median, found["none"].quality) == (1, 0, None, None, None, 0.5)
    assert statistics.merge(of(df.where("false")), "source").count() == 0


@pytest.mark.parametrize("again", [False, True])
def test_builds_in_a_folder(spark, tmp_path, again):
    folder, df = str(tmp_path / "all"), spark.createDataFrame(rows(2, 500), SCHEMA)
    for b in ("b0", "b1", "b2") + (("b1",) if again else ()):
        statistics.record(of(df.where(F.col("build") == b)).drop("build"), folder, b)
    total = lambda *builds: {r.source: (r.examples, r.characters) for r in statistics.recorded(spark, folder, "source", builds=builds).collect()}
    want = lambda d: {r.source: (r.e, r.c) for r in d.groupBy("source").agg(F.count("*").alias("e"), F.sum("n").alias("c")).collect()}
    assert total() == want(df)
    assert total("b0", "b2") == want(df.where("build <> 'b1'"))
