"""Generated tool calls: no banned number, whole quotients, prompts all unlike, and the same whatever the partitions."""

import json
import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import synthetic

BANNED = "what is 14 * 99, or 7 of 989? see 500, 501 and 12345678901234567890"


@pytest.fixture(scope="module")
def pools(spark):
    return synthetic.number_pools(spark.createDataFrame([(BANNED,), (None,), ("",)], "prompt string"))


def test_pools(spark, pools):
    row = pools.first()
    assert row.n == [x for x in range(13, 990) if x not in (14, 99, 500, 501, 989)]
    assert row.small == [x for x in range(2, 13) if x != 7] and row.quotient == [x for x in range(11, 100) if x not in (14, 99)]
    nothing = synthetic.number_pools(spark.createDataFrame([], "prompt string")).first()
    assert [len(nothing[k]) for k in ("n", "small", "quotient")] == [977, 11, 89]


def test_records(spark, pools):
    made = synthetic.tool_call_records(spark.range(20000), "id", pools, seed=5)
    rows = made.collect()
    assert len({r.input for r in rows}) == len({r.id for r in rows}) == 20000
    again = {r.position: r.input for r in synthetic.tool_call_records(spark.range(20000).repartition(7), "id", pools, seed=5).collect()}
    assert again == {r.position: r.input for r in rows}
    orders = set()
    for r in rows:
        assert (r.language, r.kind) == (("vi", "en")[r.position % 2], synthetic.KINDS[r.position // 2 % 4])
        said = json.loads(r.expected_output)
        assert said["tool"] == (None if r.kind == "none" else r.kind) and r.tools_used == ([] if r.kind == "none" else [r.kind])
        assert [m.content for m in r.messages] == [r.input, r.expected_output]
        orders.add(re.match(r"[^:]*: (.*?)\. ", r.input)[1])
        numbers = list(map(int, re.findall(r"\d+", r.input)))
        if r.kind == "calculator" and "/" in said["arguments"]["expression"]:
            a, b = map(int, said["arguments"]["expression"].split(" / "))
            assert a % b == 0 and a // b not in (14, 99) and 11 <= a // b <= 99 and b != 7 and 2 <= b <= 12
        else:
            assert not {14, 99, 500, 501, 989} & set(numbers) and all(13 <= n <= 989 for n in numbers)
            if r.kind != "none":
                assert [str(n) for n in sorted(numbers)] == sorted(re.findall(r"\d+", *said["arguments"].values()), key=int)
    assert orders == set(synthetic.ORDERS)


def test_every_combination_once_then_an_error(spark, pools):
    few = pools.select(F.array(F.lit(13), F.lit(15)).cast("array<bigint>").alias("n"), F.array(F.lit(2)).cast("array<bigint>").alias("small"), F.array(F.lit(11), F.lit(12)).cast("array<bigint>").alias("quotient"))
    all_ = spark.range(2 * 2 * 6 * 8).where("floor(id / 2) % 4 = 3")  # the kind without a tool has one form
    assert synthetic.tool_call_records(all_, "id", few).select("language", "input").distinct().count() == 48
    for position in (2 * 2 * 6 * 8 + 6, -2):
        with pytest.raises(Exception, match="no combination is left"):
            synthetic.tool_call_records(spark.range(1).select(F.lit(position).alias("id")), "id", few).collect()
    with pytest.raises(Exception, match="no combination is left"):
        synthetic.tool_call_records(spark.range(8), "id", few.withColumn("n", F.array().cast("array<bigint>"))).collect()
    assert synthetic.tool_call_records(spark.createDataFrame([(None,)], "id long"), "id", few).count() == 0


def test_more_positions_than_combinations(spark, pools):
    few = pools.select(F.sequence(F.lit(13), F.lit(24)).cast("array<bigint>").alias("n"), F.array(F.lit(2)).cast("array<bigint>").alias("small"), F.array(F.lit(11), F.lit(12)).cast("array<bigint>").alias("quotient"))
    calls = spark.range(8 * 4 * 100).where("floor(id / 2) % 4 = 0")  # a quotient has 12 combinations for 100 turns
    other = synthetic.tool_call_records(calls, "id", few, beyond="other")
    assert other.count() == other.select("language", "input").distinct().count() == 800
    again = {r.position: r.input for r in synthetic.tool_call_records(calls, "id", few, beyond="again").collect()}
    once = {r.position: r.input for r in synthetic.tool_call_records(calls.where("id < 8 * 4 * 12"), "id", few).collect()}
    assert len(again) == 800 and once.items() <= again.items()
    assert all(again[p] == again[p - 8 * 4 * 12] for p in again if p >= 8 * 4 * 12 and p // 8 % 4 == 3)
    with pytest.raises(Exception, match="no combination is left"):  # the first form has 864, of which its own turns may take 432
        synthetic.tool_call_records(spark.range(1).select(F.lit(8 * 4 * 432).alias("id")), "id", few, beyond="other").collect()
    with pytest.raises(Exception, match="no combination is left"):
        synthetic.tool_call_records(calls, "id", few.withColumn("n", F.array().cast("array<bigint>")), beyond="again").collect()
