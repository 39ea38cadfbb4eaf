"""Reports as JSON and Markdown, written to any file system that Spark reads; statistics of runs as text."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def number(value: float, digits: int = 3) -> str:
    """With a decimal comma and without zeros that say nothing."""
    return f"{round(value, digits):.{digits}f}".rstrip("0").rstrip(".").replace(".", ",") if digits else str(round(value))


def table(head: tuple[str, ...], rows: list[tuple]) -> str:
    line = lambda cells: "| " + " | ".join("-" if c is None else str(c) for c in cells) + " |"
    return "\n".join([line(head), line(["---"] * len(head)), *map(line, rows)])


def run_markdown(report: dict) -> str:
    if report["status"] != "completed":
        return f"# Evaluation of {report['model']}\n\nStatus: {report['status']}\n\n{report.get('error', '')}\n"
    share = lambda b: f"{b['accuracy']:.0%}"
    parts = [f"# Evaluation of {report['model']}", f"{report['passed']} of {report['cases']} cases passed ({share(report)})"]
    for title in ("groups", "languages"):
        parts.append(f"## By {title}\n\n" + table((title, "cases", "passed", "share"), [(k, b["cases"], b["passed"], share(b)) for k, b in report[title].items()]))
    failed = "\n".join(f"- `{f['id']}` ({f['group']}, {f['language']}, {f['scoring']}): {f['reason']}" for f in report["failures"])
    return "\n\n".join([*parts, f"## Failed\n\n{failed or 'none'}"]) + "\n"


def comparison_markdown(compared: DataFrame, before: str, after: str) -> str:
    """Of cases.compare(): a row for each part, which are few."""
    rows = sorted(compared.collect(), key=lambda r: (r.part != "all", r.part, r.value))
    rate = lambda passed, n: f"{passed}/{n}" if n else None
    points = lambda r: f"{round(100 * (r.passed_after / r.cases_after - r.passed_before / r.cases_before)):+d}" if r.cases_before and r.cases_after else None
    body = [(f"{r.part} {r.value}".strip(), rate(r.passed_before, r.cases_before), rate(r.passed_after, r.cases_after), points(r), r.newly_failed, r.newly_passed, None if r.p is None else number(r.p), r.verdict) for r in rows]
    return f"# {before} and {after}\n\n" + table(("part", "before", "after", "points", "newly failed", "newly passed", "p", "verdict"), body) + "\n"


def write(spark: SparkSession, folder: str, report: dict, markdown: str) -> None:
    """report.json and report.md as files of the folder."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name, text in (("report.json", json.dumps(report, indent=2, ensure_ascii=False) + "\n"), ("report.md", markdown)):
        path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}")
        out = path.getFileSystem(conf).create(path, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
