"""Reports of agents' runs: reading them, comparing two task by task, telling them as JSON and text, and which model does what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import reports

# The fields of a report and of its tasks.
TASK = "id string, prompt string, success boolean, reason string, answer string, tools_used array<string>, rejected_commands bigint, trace array<string>, duration_s double"
REPORT = f"status string, model string, passed bigint, total bigint, success_rate double, duration_s double, tasks array<struct<{TASK.replace(' ', ': ').replace(',:', ',')}>>, _broken string"
FIELDS = [field.split()[0] for field in TASK.split(", ")]


def load_reports(spark: SparkSession, *paths: str) -> DataFrame:
    """A row for each task of each report file: report (its path), model, position (from 0) and the fields of the task.

    A file that is no JSON object, whose status is not `completed` or whose tasks are no list stops with an error that
    names up to five such files. A report without tasks gives no row.
    """
    files = spark.read.text(list(paths), wholetext=True).select(F.input_file_name().alias("report"), F.from_json("value", REPORT, {"columnNameOfCorruptRecord": "_broken"}).alias("r"))
    sound = (F.col("r.status") == "completed") & F.col("r.tasks").isNotNull() & F.col("r._broken").isNull()
    wrong = [r.report for r in files.where(~F.coalesce(sound, F.lit(False))).select("report").orderBy("report").limit(5).collect()]
    if wrong:
        raise ValueError(f"not reports of completed runs with a list of tasks: {', '.join(wrong)}")
    rows = files.select("report", "r.model", F.posexplode("r.tasks").alias("position", "task"))
    return rows.select("report", "model", "position", "task.*")


def summarize(tasks: DataFrame, *by: str) -> DataFrame:
    """total, passed, success_rate (four decimals, 0 without tasks) and minutes (one decimal) for each of by. Tasks without a verdict have not passed."""
    passed, seconds = F.count_if(F.coalesce("success", F.lit(False))), F.coalesce(F.sum("duration_s"), F.lit(0.0))
    counted = tasks.groupBy(*by).agg(F.count("*").alias("total"), passed.alias("passed"), seconds.alias("_s"))
    rate = F.when(F.col("total") > 0, F.bround(F.col("passed").cast("double") / F.col("total"), 4)).otherwise(0.0)
    return counted.select(*by, "total", "passed", rate.alias("success_rate"), F.bround(F.col("_s") / 60, 1).alias("minutes"))


def compare(first: DataFrame, second: DataFrame) -> DataFrame:
    """A row for each task of either run: id, place, success, reason and duration_s of both runs, and change.

    first and second: tasks with id, position, success, reason and duration_s. change is `same`, `newly passed`, `newly failed`,
    or `only in first` and `only in second`, which are no changes. place orders tasks as in the first run, then those of the second
    alone. Of a repeated id the last task counts, at the place of the first; null ids are one task. Both runs meet in one
    aggregation by id, whose partial results are a task a run, so a repeated id is no hot group.
    """
    one = lambda df, run: df.select("id", F.lit(run).alias("run"), "position", F.struct(F.coalesce("success", F.lit(False)).alias("success"), "reason", "duration_s").alias("task"))
    both = one(first, 1).unionByName(one(second, 2))
    of = lambda c, run: F.when(F.col("run") == run, c)
    grouped = both.groupBy("id").agg(
        F.min(F.struct("run", "position")).alias("place"),
        *[F.max_by(of(F.col("task"), run), of(F.col("position"), run)).alias(name) for run, name in ((1, "first"), (2, "second"))],
    )
    a, b = F.col("first.success"), F.col("second.success")
    change = F.when(a.isNull(), "only in second").when(b.isNull(), "only in first").when(a == b, "same").when(b, "newly passed").otherwise("newly failed")
    return grouped.select("id", "place", *[F.col(f"{run}.{c}").alias(f"{run}_{c}") for run in ("first", "second") for c in ("success", "reason", "duration_s")], change.alias("change"))


def comparison_report(first: DataFrame, second: DataFrame, labels: tuple[str, str] = ("first", "second")) -> tuple[dict, str]:
    """compare() of two loaded reports as a dict for JSON and as Markdown. Tasks of a report are what people wrote, so they are told on the driver one by one."""
    rows = [r.asDict(recursive=True) for r in compare(first, second).orderBy("place").toLocalIterator()]
    sums = [(summarize(df).first().asDict(), df.agg(F.max("model")).first()[0]) for df in (first, second)]
    changed = lambda what: [r["id"] for r in rows if r["change"] == what]
    alone = [r["id"] for r in rows if r["change"].startswith("only")]
    told = {"labels": list(labels), "models": [m for _, m in sums], "summary": [s for s, _ in sums], "tasks": [{k: v for k, v in r.items() if k != "place"} for r in rows], "newly_passed": changed("newly passed"), "newly_failed": changed("newly failed"), "only_in_one": alone}
    cell = lambda r, run: None if r[f"{run}_success"] is None else "passed" if r[f"{run}_success"] else f"failed ({r[f'{run}_reason']})"
    body = [(r["id"], cell(r, "first"), cell(r, "second")) for r in rows]
    body += [("**passed**", *(f"{s['passed']}/{s['total']} ({s['success_rate']:.0%})" for s, _ in sums)), ("minutes", *(reports.number(s["minutes"], 1) for s, _ in sums))]
    listed = "\n".join(f"- {title}: {', '.join(map(str, ids)) or 'none'}" for title, ids in (("newly passed", told["newly_passed"]), ("newly failed", told["newly_failed"]), ("only in one", alone)))
    head = " and ".join(f"{label} ({model})" for label, (_, model) in zip(labels, sums))
    return told, f"# {head}\n\n{reports.table(('task', *labels), body)}\n\n{listed}\n"


def run_text(tasks: DataFrame, width: int = 400) -> str:
    """One loaded report as text: each task with its trace, whose steps are cut at width, and the share that passed."""
    parts = []
    for r in tasks.orderBy("position").toLocalIterator():
        steps = [s if len(s) <= width else s[:width] + "…" for s in r.trace or []]
        verdict = "passed" if r.success else f"failed: {r.reason}"
        parts.append("\n".join([f"## {r.id} {verdict}", f"asked: {r.prompt}", *("  " + s.strip("\n").replace("\n", "\n    ") for s in steps), f"answer: {r.answer}", f"tools: {', '.join(r.tools_used or []) or 'none'}"]))
    s = summarize(tasks).first()
    return "\n\n".join([*parts, f"{s.passed} of {s.total} passed ({s.success_rate:.0%}) in {reports.number(s.minutes, 1)} minutes"]) + "\n"


def route(requests: DataFrame, models: DataFrame, capability: str = "capability", default: str | None = None) -> DataFrame:
    """requests with model: the first of models (name, place, capabilities) that can do what the row asks for, else the default.

    The default must be one of the models; without it, a request that no model can do, or that asks for nothing, stops the
    query. Models come to requests as one row a capability, by a join on it.
    """
    known = default is not None and not models.where(F.col("name") == default).isEmpty()
    each = models.select("name", "place", F.explode("capabilities").alias("_can"))
    able = each.groupBy("_can").agg(F.min_by("name", F.struct("place", "name")).alias("model"))
    asked: Column = F.coalesce(F.col(capability).cast("string"), F.lit("null"))
    otherwise = F.lit(default) if known else F.raise_error(F.concat(F.lit("no model for "), asked)).cast("string")
    return requests.join(able, F.col(capability) == F.col("_can"), "left").select(*requests.columns, F.coalesce("model", otherwise).alias("model"))
