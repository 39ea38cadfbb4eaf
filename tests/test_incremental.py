"""Evaluations that go on from a cache: what is scored again, and that results are those of one whole run."""

from pyspark.sql import functions as F

from millrace.operators import cases, incremental

KIND = "id string, prompt string, scoring string, expected string, pattern string, group string, language string"
ROWS = [(str(k), f"prompt {k}", ["exact", "contains", "regex"][k % 3], f"a{k % 7}", f"a{k % 5}$", "g", "en") for k in range(40)]
SETTINGS = {"model": "m", "revision": "1", "max_new_tokens": 512, "generation": {"greedy": True}}


def rows(df):
    return sorted((r["id"], r["output"], r["passed"], r["reason"]) for r in df.collect())


def test_only_changes_are_scored_again(spark, tmp_path):
    asked = []

    def answer(df):
        asked.append(sorted(r["id"] for r in df.collect()))
        n = F.col("id").cast("int")
        return df.select("id", F.when(n != 13, F.concat(F.lit("a"), (n % 6).cast("string"))).alias("output"))

    folder, frame = str(tmp_path / "cache"), spark.createDataFrame(ROWS, KIND)
    whole = rows(cases.run(frame, answer(frame)))
    asked.clear()
    first = incremental.evaluate(frame, answer, SETTINGS, folder)
    assert first.scored == 40 and rows(first.results) == whole and first.results.where("fresh").count() == 40
    # the case without an output is tried again, nothing else
    again = incremental.evaluate(frame.repartition(3), answer, SETTINGS, folder)
    assert again.scored == 1 and asked[-1] == ["13"] and rows(again.results) == whole
    changed = spark.createDataFrame([(*r[:3], "a0" if r[0] in ("6", "9") else r[3], *r[4:]) for r in ROWS if r[0] != "13"] + [("new", "p", "exact", "anull", None, "g", "en")], KIND).where("id <> 'new'")
    third = incremental.evaluate(changed, answer, SETTINGS, folder)
    assert third.scored == 2 and asked[-1] == ["6", "9"] and rows(third.results) == rows(cases.run(changed, answer(changed)))
    assert sorted(r["id"] for r in third.results.where("fresh").collect()) == ["6", "9"]
    asked.clear()
    last = incremental.evaluate(changed, answer, dict(reversed(SETTINGS.items())), folder)
    assert last.scored == 0 and asked == [] and rows(last.results) == rows(third.results)
    assert incremental.evaluate(changed, answer, {**SETTINGS, "revision": "2"}, folder).scored == 39
    assert incremental.evaluate(changed.where("false"), answer, SETTINGS, folder).results.collect() == []


def test_repeated_cases_and_extra_columns(spark, tmp_path):
    frame = spark.createDataFrame([(*r, "x", True) for r in ROWS[:3]] * 2, KIND + ", source string, note boolean")
    answer = lambda df: df.select("id", F.lit("a0").alias("output")).distinct()
    done = incremental.evaluate(frame, answer, {}, str(tmp_path / "cache"))
    assert done.results.count() == 6 and incremental.evaluate(frame, answer, {}, str(tmp_path / "cache")).scored == 0
