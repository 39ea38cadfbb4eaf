"""Command lines, run in the session of the tests, on files."""

import json

import pytest

from millrace.commands import main


def record(i, text, domain="chat"):
    return {"id": i, "domain": domain, "task": "sft", "input": text, "expected_output": "an answer", "source": {"name": "s"}, "license": {"name": "mit"}, "dataset_version": "v1"}


@pytest.fixture
def rows(tmp_path):
    path = tmp_path / "rows.jsonl"
    path.write_text("".join(json.dumps(r) + "\n" for r in [record("a", "one question"), record("b", "one question"), record("c", "another", "coding"), record("d", ""), record("c", "again")]), encoding="utf-8")
    return str(path)


def run(spark, capsys, *argv):
    code = main(list(map(str, argv)), spark)
    out, err = capsys.readouterr()
    return code, (json.loads(out) if out.startswith("{") else out), err


def lines(folder):
    return [json.loads(x) for f in sorted(folder.glob("part-*")) for x in f.read_text(encoding="utf-8").splitlines()]


def test_inspect_validate_deduplicate(spark, capsys, rows, tmp_path):
    code, told, _ = run(spark, capsys, "inspect", rows)
    assert code == 0 and told["examples"] == 5 and told["columns"]["input"] == {"type": "string", "nulls": 0}
    code, told, _ = run(spark, capsys, "validate", rows)
    assert code == 1 and told["errors"] == {"duplicate:id": 1, "missing:input": 1} and told["first"] == [["c", "duplicate:id"], ["d", "missing:input"]]
    code, told, _ = run(spark, capsys, "deduplicate", rows, "--output", tmp_path / "out")
    assert code == 0 and told == {"examples": 5, "invalid": 2, "duplicates": 1, "kept": 2}
    assert sorted(r["id"] for r in lines(tmp_path / "out")) == ["a", "c"]


def test_stats_of_two_builds(spark, capsys, rows, tmp_path):
    for name in ("one", "two", "one"):
        code, told, _ = run(spark, capsys, "stats", rows, "--builds", tmp_path / "builds", "--build", name)
    assert code == 0 and told["statistics"]["examples"] == 5
    assert {k: v["examples"] for k, v in told["all_builds"].items()} == {"chat": 8, "coding": 2}


def test_build(spark, capsys, rows, tmp_path):
    (tmp_path / "quality.json").write_text('{"language": false, "length": true}')
    code, told, _ = run(spark, capsys, "build", rows, "--output", tmp_path / "out", "--version", "v2", "--quality", tmp_path / "quality.json")
    assert code == 0 and told["version"] == "v2" and told["statistics"]["examples"] == 2 and told["rejected"] == 3
    (tmp_path / "bad.json").write_text('{"no_such_key": 1}')
    code, _, err = run(spark, capsys, "build", rows, "--output", tmp_path / "other", "--version", "v2", "--quality", tmp_path / "bad.json")
    assert code == 2 and "no_such_key" in err and not (tmp_path / "other").exists()
    (tmp_path / "cases.jsonl").write_text(json.dumps({"id": "a", "prompt": "something else", "expected": "x"}) + "\n")
    code, _, err = run(spark, capsys, "build", rows, "--output", tmp_path / "other", "--version", "v2", "--evaluation", tmp_path / "cases.jsonl")
    assert code == 2 and "evaluation" in err


def test_secrets_presets_and_agents(spark, capsys, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "clean.txt").write_text("nothing here")
    assert run(spark, capsys, "secret-scan", folder)[:2] == (0, {"files": 0, "first": []})
    (folder / "bad.txt").write_text("password = abcdefgh12345678")
    code, told, _ = run(spark, capsys, "secret-scan", folder)
    assert code == 1 and told["files"] == 1 and told["first"][0].endswith("bad.txt") and "abcdefgh" not in json.dumps(told)
    specs = tmp_path / "presets"
    specs.mkdir()
    (specs / "code.json").write_text(json.dumps({"name": "n", "license": "mit", "mapping": {"input": "q", "expected_output": "a"}, "limit": 5}))
    assert run(spark, capsys, "presets", specs)[:2] == (0, {"code": {"license": "mit", "limit": 5, "domain": "reasoning"}})
    task = {"id": "t", "prompt": "p", "success": True, "duration_s": 6.0}
    for name, fine in (("one", True), ("two", False)):
        (tmp_path / name).write_text(json.dumps({"status": "completed", "model": name, "tasks": [{**task, "success": fine, "reason": None if fine else "wrong"}]}))
    code, text, _ = run(spark, capsys, "compare-agents", tmp_path / "one", tmp_path / "two", "--output", tmp_path / "compared")
    assert code == 0 and "newly failed: t" in text and json.loads((tmp_path / "compared" / "report.json").read_text())["newly_failed"] == ["t"]
    code, text, _ = run(spark, capsys, "agent-report", tmp_path / "two")
    assert code == 0 and "## t failed: wrong" in text
    assert run(spark, capsys, "agent-report", folder / "clean.txt")[0] == 2


def test_preference_from_metadata(spark):
    from millrace.operators import formats

    rows = spark.createDataFrame([("a", "q", "good", ("bad",)), ("b", "q", "good", ("",)), ("c", "q", "good", None)], "id string, input string, expected_output string, metadata struct<rejected_output:string>")
    assert [tuple(r) for r in formats.prepare(rows, "preference").collect()] == [("a", "q", "good", "bad")]
    flat = rows.drop("metadata")
    assert [formats.prepare(flat, kind).count() for kind in ("preference", "tool_use", "trajectory", "reasoning", "sft")] == [0, 0, 0, 0, 3]
