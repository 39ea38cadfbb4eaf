"""Agents' reports from files, compared task by task, and models by what they can do."""

import json

import pytest

from millrace.operators import agents, cost, reports

TASKS = [
    {"id": "sum", "prompt": "add", "success": True, "reason": None, "answer": "3", "tools_used": ["calculator"], "rejected_commands": 0, "trace": ["one", "two\nlines\n"], "duration_s": 60.0},
    {"id": "list", "prompt": "ls", "success": False, "reason": "wrong answer", "answer": "", "tools_used": [], "trace": ["x" * 30], "duration_s": 30.5},
]


def written(folder, name, **fields):
    path = folder / name
    path.write_text(json.dumps({"status": "completed", "model": name, "tasks": TASKS} | fields, indent=1), encoding="utf-8")
    return str(path)


def test_load_and_tell(spark, tmp_path):
    first = agents.load_reports(spark, written(tmp_path, "base"))
    second = agents.load_reports(spark, written(tmp_path, "tuned", tasks=[{**TASKS[1], "success": True}, {**TASKS[0], "id": "new", "success": None, "reason": "đứt"}]))
    assert [(r.id, r.position, r.tools_used) for r in first.orderBy("position").collect()] == [("sum", 0, ["calculator"]), ("list", 1, [])]
    told, text = agents.comparison_report(first, second, ("before", "after"))
    assert (told["newly_passed"], told["newly_failed"], told["only_in_one"]) == (["list"], [], ["sum", "new"])
    assert [t["id"] for t in told["tasks"]] == ["sum", "list", "new"] and told["models"] == ["base", "tuned"]
    assert told["summary"] == [{"total": 2, "passed": 1, "success_rate": 0.5, "minutes": 1.5}] * 2
    assert "| list | failed (wrong answer) | passed |" in text and "| sum | passed | - |" in text and "| new | - | failed (đứt) |" in text and "| minutes | 1,5 | 1,5 |" in text
    reports.write(spark, str(tmp_path / "out"), told, text)
    assert json.loads((tmp_path / "out" / "report.json").read_text(encoding="utf-8")) == told
    shown = agents.run_text(first, width=10)
    assert "## sum passed" in shown and "  two\n    lines\n" in shown and "x" * 10 + "…" in shown and "x" * 11 not in shown and shown.endswith("1 of 2 passed (50%) in 1,5 minutes\n")


@pytest.mark.parametrize("fields", [{"status": "running"}, {"tasks": None}, {"tasks": {"id": "x"}}, {"status": None}])
def test_other_reports_stop(spark, tmp_path, fields):
    good = written(tmp_path, "good")
    with pytest.raises(ValueError, match="bad"):
        agents.load_reports(spark, good, written(tmp_path, "bad", **fields))


def test_no_json_and_no_tasks(spark, tmp_path):
    (tmp_path / "bad").write_text("[not json")
    with pytest.raises(ValueError, match="bad"):
        agents.load_reports(spark, str(tmp_path / "bad"))
    empty = agents.load_reports(spark, written(tmp_path, "empty", tasks=[]))
    assert empty.count() == 0 and agents.summarize(empty).first().asDict() == {"total": 0, "passed": 0, "success_rate": 0.0, "minutes": 0.0}
    assert agents.comparison_report(empty, empty)[0]["tasks"] == []


def test_repeated_and_null_ids(spark):
    of = lambda *rows: spark.createDataFrame(list(rows), "id string, position int, success boolean, reason string, duration_s double")
    found = {r.id: r for r in agents.compare(of(("a", 0, False, "x", 1.0), ("b", 1, True, None, 1.0), ("a", 2, True, None, 2.0), (None, 3, True, None, 1.0)), of(("b", 0, False, "y", 1.0), ("a", 1, True, None, 1.0), (None, 2, None, None, None), ("c", 3, True, None, None))).collect()}
    assert {k: r.change for k, r in found.items()} == {"a": "same", "b": "newly failed", None: "newly failed", "c": "only in second"}
    assert found["a"].first_duration_s == 2.0 and sorted(found, key=lambda k: tuple(found[k].place)) == ["a", "b", None, "c"]


def test_route(spark):
    models = spark.createDataFrame([("small", 0, ["chat"]), ("large", 1, ["chat", "code"]), ("none", 2, None)], "name string, place int, capabilities array<string>")
    asked = spark.createDataFrame([(1, "chat"), (2, "code"), (3, "draw"), (4, None)], "n int, capability string")
    assert {r.n: r.model for r in agents.route(asked, models, default="none").collect()} == {1: "small", 2: "large", 3: "none", 4: "none"}
    assert agents.route(asked.where("n < 3"), models).count() == 2
    for default in (None, "unknown"):
        with pytest.raises(Exception, match="no model for draw"):
            agents.route(asked.where("n = 3"), models, default=default).collect()


RUN = "params_b double, precision string, rows bigint, tokens_per_row double, length bigint, batch bigint, accumulation bigint, epochs bigint, max_steps bigint, checkpointing boolean, done bigint, cases bigint, new_tokens bigint, device string"


def test_calibrate(spark):
    """A measured run of half a billion parameters: 125 steps of 16 rows in 896.9 s are 5.37 effective teraflops."""
    base = (0.49, "4bit", 2000, 820.0, 1024, 4, 4, 1, 0, True, 0, 30, 512, "Tesla T4")
    measured = [(0, 125, 896.9, 2.5), (125, 125, 3.0, 2.5), (None, 125, 896.9, None), (0, 0, None, None)]
    rows = [base + m for m in measured] + [base[:-1] + ("other",) + measured[0], (14.0, "bf16", *base[2:], *measured[0])]
    got = cost.calibrate(spark.createDataFrame(rows, RUN + ", start_step bigint, end_step bigint, train_seconds double, peak_gb double")).collect()
    assert abs(got[0].effective_tflops - 2 * 0.49e9 * 16 * 820 * 125 * 3 / 896.9 / 1e12) < 1e-9 and got[0].ran_steps == 125 and not got[0].reliable
    assert abs(got[0].estimated_minutes - got[0].train_minutes) < 1e-9 and abs(got[0].kbit_overhead_gb - (2.5 - 0.49 * 4.5 / 8 * 1.25) / 0.7) < 1e-9
    assert (got[1].ran_steps, got[1].effective_tflops, got[1].training_factor, got[1].reliable) == (0, None, None, None)
    assert got[2].effective_tflops == got[0].effective_tflops and got[2].training_factor is None and got[3].measured_minutes is None
    assert got[4].effective_tflops == got[0].effective_tflops and got[4].estimated_minutes is None and got[4].reliable is None
    assert got[5].kbit_overhead_gb is None and abs(got[5].training_factor - 2.5 / 28) < 1e-9 and got[5].reliable


def test_eval_overheads(spark):
    rows = [("a", "completed", 132.0, 10000, 1.0, 0.49, "T4"), ("a", "completed", 156.0, 9000, None, 0.49, "T4"), ("a", "running", 9.0, 9, 1.0, 0.49, "T4"), ("b", "completed", 0.001, 9000, 2.0, 0.49, "T4"), ("b", "completed", 5.0, 0, 2.0, 0.49, "T4"), ("c", "completed", 5.0, 9, 2.0, 0.49, None)]
    got = {r.model: r for r in cost.eval_overheads(spark.createDataFrame(rows, "model string, status string, duration_s double, output_chars bigint, load_s double, params_b double, device string"), "model").collect()}
    want = sum(d / (c / 3.4) - 0.98 / 190 for d, c in ((132, 10000), (156, 9000))) / 2
    assert set(got) == {"a", "b"} and abs(got["a"].overhead - want) < 1e-12 and not got["a"].clean and got["a"].reports == 2
    assert got["b"].overhead == 0.0 and got["b"].clean and got["b"].reports == 1
