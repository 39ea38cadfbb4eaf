"""Evaluation: cases and their rules, runs of a model, and comparisons of two runs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import scoring

# The vocabularies of a case, and the field that each way of scoring needs.
NEEDS = {"exact": "expected", "contains": "expected", "regex": "pattern", "python_tests": "tests"}
LANGUAGES = ("vi", "en")
GROUPS = ("code", "reasoning", "tool_use")


def case_errors(df: DataFrame) -> Column:
    """Codes of what is wrong with a case; columns that df lacks are empty."""
    of = lambda c: F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("")
    codes = [F.when(~of("scoring").isin(*NEEDS), "invalid:scoring"), F.when(~of("language").isin(*LANGUAGES), "invalid:language")]
    codes += [F.when(~of("group").isin(*GROUPS), "invalid:group")] if "group" in df.columns else []
    codes += [F.when((of("scoring") == kind) & (of(field) == ""), f"missing:{field}") for kind, field in NEEDS.items()]
    return F.array_compact(F.array(*codes))


def load_cases(df: DataFrame) -> DataFrame:
    """df, if all its cases are sound, their ids unlike and their patterns readable; otherwise an error that names up to five of them. A set of cases is what a person can write, so its patterns are read on the driver."""
    wrong = df.select("id", case_errors(df).alias("errors")).where(F.size("errors") > 0).limit(5).collect()
    if wrong:
        raise ValueError(f"cases with errors: {[(r.id, list(r.errors)) for r in wrong]}")
    twice = df.groupBy("id").count().where("count > 1").orderBy("id").limit(5).collect()
    if twice:
        raise ValueError(f"repeated ids of cases: {[r.id for r in twice]}")
    if "pattern" in df.columns:
        for row in df.where("scoring = 'regex'").select("id", "pattern").toLocalIterator():
            try:
                re.compile(row.pattern)
            except re.error as error:
                raise ValueError(f"case {row.id}: {error}") from error
    return df


def passed(df: DataFrame) -> Column:
    """Whether `output` passes its case. Code is never run: cases that need it are null."""
    has = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    answer, kind = T.strip_think(F.coalesce("output", F.lit(""))), F.col("scoring")
    return F.when(kind == "exact", scoring.exact(answer, has("expected"))).when(kind == "contains", scoring.contains(answer, has("expected"))).when(kind == "regex", scoring.regex(T.nfc(answer), T.nfc(has("pattern"))))


def run(cases: DataFrame, outputs: DataFrame) -> DataFrame:
    """cases with output, passed and reason. outputs: id, output; a case without one has not passed."""
    done = cases.join(outputs.select("id", "output"), "id", "left")
    done = done.withColumn("passed", F.coalesce(passed(done), F.lit(False)))
    why = F.when(F.col("output").isNull(), "no output").when(F.col("scoring") == "python_tests", "code is not run").otherwise(F.concat(F.lit("not "), "scoring"))
    return done.withColumn("reason", F.when(~F.col("passed"), why))


def report(done: DataFrame, model: str) -> dict:
    """What run() gave as counts: over all, by group and language, and every case that failed, in order of id."""
    rows = scoring.buckets(done, ("group", "language"), F.col("passed"), F.length(F.coalesce("output", F.lit("")))).collect()
    tell = lambda r: {"cases": r.cases, "passed": r.passed, "accuracy": round(r.accuracy, 4)}
    whole = next(r for r in rows if r.group is None and r.language is None)
    failed = done.where("not passed").select("id", "group", "language", "scoring", "reason", F.substring("output", 1, 300).alias("output")).orderBy("id")
    parts = lambda c: {r[c]: tell(r) for r in sorted((r for r in rows if r[c] is not None), key=lambda r: r[c])}
    return {"status": "completed", "model": model, **(tell(whole) if whole.cases else {"cases": 0, "passed": 0, "accuracy": 0.0}), "groups": parts("group"), "languages": parts("language"), "output_chars": whole.chars or 0, "failures": [r.asDict() for r in failed.toLocalIterator()]}


def compare(before: DataFrame, after: DataFrame, by: tuple[str, ...] = ("group", "language")) -> DataFrame:
    """part, value, cases and passes before and after, newly_failed, newly_passed, p and verdict: over all and for each value of each column.

    Parts whose cases are not the same in both runs are `not paired`, and a part that one run lacks has nulls there.
    """
    one = before.select("id", *by, F.col("passed").alias("b")).join(after.select("id", *[F.col(c).alias(f"{c}_2") for c in by], F.col("passed").alias("a")), "id", "full_outer")
    one = one.select("id", "a", "b", *[F.coalesce(c, f"{c}_2").alias(c) for c in by])
    parts = F.explode(F.array(F.struct(F.lit("all").alias("part"), F.lit("").alias("value")), *[F.struct(F.lit(c).alias("part"), F.col(c).alias("value")) for c in by]))
    rows = one.select("a", "b", parts.alias("x")).select("x.part", "x.value", "a", "b").groupBy("part", "value")
    n = rows.agg(
        F.count("b").alias("cases_before"),
        F.count("a").alias("cases_after"),
        F.count_if("b").alias("passed_before"),
        F.count_if("a").alias("passed_after"),
        F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("alone"),
        F.count_if(F.col("b") & ~F.col("a")).alias("newly_failed"),
        F.count_if(F.col("a") & ~F.col("b")).alias("newly_passed"),
    )
    paired = F.col("alone") == 0
    p = F.when(paired, scoring.mcnemar(F.col("newly_failed"), F.col("newly_passed")))
    out = n.withColumn("p", p).withColumn("verdict", F.when(~paired, "not paired").otherwise(scoring.verdict(F.col("newly_failed") + F.col("newly_passed"), F.col("p"))))
    return out.withColumns({c: F.when(paired, F.col(c)) for c in ("newly_failed", "newly_passed")}).drop("alone")
