"""Command lines over the library: `python -m millrace COMMAND ...`, or by spark-submit. Paths are any that Spark reads, and results that may be long are written by Spark.

Exit codes: 0 done, 1 something is wrong with the records (validate, secret-scan), 2 what was asked for cannot be done.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import agents, mixing, quality, reports, statistics, validation
from .plans import build as B
from .sources import readers, writers


def show(told: dict) -> None:
    print(json.dumps(told, indent=2, ensure_ascii=False, default=str))


def records(spark: SparkSession, a) -> DataFrame:
    return readers.load_all(spark, a.records).drop("source_no")


def inspect(spark: SparkSession, a) -> int:
    """Rows, columns and their types, and how many of each are null."""
    df = records(spark, a)
    row = df.agg(F.count("*"), *[F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns]).first()
    show({"examples": row[0], "columns": {c: {"type": kind, "nulls": n} for (c, kind), n in zip(df.dtypes, row[1:])}})
    return 0


def validate(spark: SparkSession, a) -> int:
    """How many records each code is held against, and the ids of the first few."""
    df = records(spark, a)
    placed = B.shared(df.select("id", validation.errors(df).alias("errors"), F.monotonically_increasing_id().alias("place")))
    found = validation.with_duplicate_ids(placed, "id", "place").select("id", F.explode("errors").alias("code"))
    codes = {r.code: r.n for r in found.groupBy("code").agg(F.count("*").alias("n")).orderBy("code").collect()}  # as many as there are codes
    first = [tuple(r) for r in found.orderBy("id", "code").limit(a.show).collect()] if codes else []
    show({"examples": df.count(), "errors": codes, "first": first})
    return 1 if codes else 0


def deduplicate(spark: SparkSession, a) -> int:
    """Writes the sound records without those whose content an earlier id has."""
    told = B.shared(B.annotate(records(spark, a)))
    fine = F.size("errors") == 0
    writers.write_jsonl(told.where(fine & F.col("duplicate_of").isNull()).drop("errors", "duplicate_of", "quality_filter", "quality_reason"), a.output)
    n = told.agg(F.count("*"), F.count_if(~fine), F.count("duplicate_of")).first()
    show({"examples": n[0], "invalid": n[1], "duplicates": n[2], "kept": n[0] - n[1] - n[2]})
    return 0


def stats(spark: SparkSession, a) -> int:
    """Statistics of records; with a folder of builds, they are kept there too, and those of all its builds are told beside them."""
    df = records(spark, a)
    told = {"statistics": statistics.statistics(df), "quality": statistics.quality_statistics(df)}
    if a.builds:
        size = validation.ascii_length(validation.canonical_json(df))
        statistics.record(statistics.summary(df, "domain", length=size, score=F.col("quality_score") if "quality_score" in df.columns else None), a.builds, a.build)
        rows = statistics.told(statistics.recorded(spark, a.builds, "domain")).orderBy("domain").collect()  # a row a domain
        told["all_builds"] = {r.domain: {k: v for k, v in r.asDict().items() if k != "domain"} for r in rows}
    show(told)
    return 0


def build(spark: SparkSession, a) -> int:
    """The whole build; the manifest is told."""
    config = json.loads("".join(r.value for r in spark.read.text(a.quality, wholetext=True).collect())) if a.quality else False  # one small file
    weights = mixing.parse_mix(a.mix).to_dict() if a.mix else None
    cases = readers.load_all(spark, a.evaluation).drop("source_no") if a.evaluation else None
    show(B.build(records(spark, a), a.output, a.version, cases, quality.QualityConfig.of(config), weights, tuple(a.kind or ["sft"]), a.seed, tuple(a.records), tuple(a.evaluation or ())))
    return 0


def presets(spark: SparkSession | None, a) -> int:
    show({name: {"license": s.license, "limit": s.limit, "domain": s.domain} for name, s in readers.presets(a.folder).items()})
    return 0


def secret_scan(spark: SparkSession, a) -> int:
    """How many files hold what looks like a secret, and the first few of them; never the secret."""
    found = readers.text_files(spark, a.folder).where(T.has_secret(F.col("value"))).select("path")
    n = found.count()
    show({"files": n, "first": [r.path for r in found.orderBy("path").limit(a.show).collect()]})
    return 1 if n else 0


def compare_agents(spark: SparkSession, a) -> int:
    told, text = agents.comparison_report(agents.load_reports(spark, a.first), agents.load_reports(spark, a.second), tuple(a.labels))
    print(text, end="")
    if a.output:
        reports.write(spark, a.output, told, text)
    return 0


def agent_report(spark: SparkSession, a) -> int:
    print(agents.run_text(agents.load_reports(spark, a.report), a.width), end="")
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace", description=__doc__.splitlines()[0])
    of = top.add_subparsers(dest="command", required=True)

    def command(run, *more: str):
        p = of.add_parser(run.__name__.replace("_", "-"), help=(run.__doc__ or "").strip() or None)
        p.set_defaults(run=run)
        for name in more:
            p.add_argument(name, **({"nargs": "+"} if name == "records" else {}))
        return p

    command(inspect, "records")
    command(validate, "records").add_argument("--show", type=int, default=10)
    command(deduplicate, "records").add_argument("--output", required=True)
    p = command(stats, "records")
    p.add_argument("--builds")
    p.add_argument("--build", default="latest")
    p = command(build, "records")
    p.add_argument("--output", required=True)
    p.add_argument("--version", required=True)
    p.add_argument("--evaluation", nargs="+")
    p.add_argument("--quality", help="a JSON file: true, or keys of the filters' settings")
    p.add_argument("--mix", nargs="+", metavar="DOMAIN:WEIGHT")
    p.add_argument("--kind", nargs="+")
    p.add_argument("--seed", type=int, default=0)
    command(presets, "folder")
    command(secret_scan, "folder").add_argument("--show", type=int, default=10)
    p = command(compare_agents, "first", "second")
    p.add_argument("--labels", nargs=2, default=["first", "second"])
    p.add_argument("--output")
    command(agent_report, "report").add_argument("--width", type=int, default=400)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        return a.run(spark or (None if a.run is presets else SparkSession.builder.appName("millrace").getOrCreate()), a)
    except (ValueError, LookupError) as error:  # EvalOverlap is one
        print(error, file=sys.stderr)
        return 2
