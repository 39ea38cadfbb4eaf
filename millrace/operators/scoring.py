"""Scores of answers and records, buckets of them, and comparisons of two runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def exact(answer: Column, expected: Column) -> Column:
    return T.eval_form(answer) == T.eval_form(expected)


def contains(answer: Column, expected: Column) -> Column:
    return F.contains(T.eval_form(answer), T.eval_form(expected))


def regex(answer: Column, pattern: Column) -> Column:
    """Found anywhere; a dot is any character, and case is that of no script."""
    return F.rlike(answer, F.concat(F.lit("(?isu)"), pattern))


def record_score(valid: Column, verified: Column, reasoned: Column, has_url: Column) -> Column:
    yes = lambda c, points: F.when(F.coalesce(c, F.lit(False)), F.lit(points)).otherwise(F.lit(0))
    return (F.least(F.lit(35) + yes(valid, 25) + yes(verified, 25) + yes(reasoned, 10) + yes(has_url, 5), F.lit(100)) / 100).cast("double")


def buckets(df: DataFrame, by: tuple[str, ...], passed: Column, chars: Column) -> DataFrame:
    """Cases, passes, accuracy and characters for each value of each column, and over all."""
    d = df.select(*by, passed.alias("_p"), chars.alias("_c"))
    sets = [[F.col(c)] for c in by] + [[]]
    return d.groupingSets(sets, *by).agg(F.count("*").alias("cases"), F.count_if("_p").alias("passed"), (F.count_if("_p").cast("double") / F.count("*")).alias("accuracy"), F.sum("_c").alias("chars"))


def flips(df: DataFrame, by: str) -> DataFrame:
    """Of cases of two runs, with before and after: newly failed and newly passed."""
    return df.groupBy(by).agg(F.count_if(F.col("before") & ~F.col("after")).alias("newly_failed"), F.count_if(F.col("after") & ~F.col("before")).alias("newly_passed"))


def mcnemar(failed: Column, passed: Column) -> Column:
    """Exact two-sided p of McNemar's test: twice the binomial tail of the smaller count, 1 at most.

    Beyond 1,000 flips the terms are added up by their logarithms, since the powers of two no longer fit. Negative counts stop the query."""
    n, k = failed + passed, F.least(failed, passed)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum"))
    step = lambda s, i: F.struct((s["term"] * (n - i) / (i + 1)).alias("term"), (s["sum"] + s["term"]).alias("sum"))
    tail = F.aggregate(F.sequence(F.lit(0).cast("bigint"), k), start, step, lambda s: s["sum"])
    begin = F.struct((-n * F.log(F.lit(2.0))).alias("log"), F.lit(0.0).alias("sum"))
    more = lambda s, i: F.struct((s["log"] + F.log((n - i).cast("double") / (i + 1))).alias("log"), (s["sum"] + F.exp(s["log"])).alias("sum"))
    by_logs = F.aggregate(F.sequence(F.lit(0).cast("bigint"), k), begin, more, lambda s: s["sum"])
    p = F.when(n <= 1000, 2 * tail / F.pow(F.lit(2.0), n)).otherwise(2 * by_logs)
    wrong = F.raise_error(F.lit("counts of flips are not negative")).cast("double")
    return F.when((failed < 0) | (passed < 0), wrong).when(n == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), p))


def verdict(n: Column, p: Column) -> Column:
    return F.when(n == 0, "unchanged").when(p < 0.05, "real").otherwise("uncertain")


def agent_reason(completed: Column, matches: Column, tools: Column, used: Column, must_retry: Column | None = None, rejected: Column | None = None) -> Column:
    """Why a run failed, the first of the reasons; null if it passed. rejected: how many tools had been used at each rejected command."""
    out = F.when(~completed, "not completed").when(~matches, "wrong answer").when(F.size(F.array_except(tools, used)) > 0, "missing tool")
    if must_retry is not None:
        again = F.exists(rejected, lambda i: F.array_contains(F.slice(used, i + 1, F.greatest(F.size(used), F.lit(1))), "terminal"))
        out = out.when(must_retry & ~again, "no retry after a rejection")
    return out
