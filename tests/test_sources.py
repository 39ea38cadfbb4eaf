"""Readers against csv and json, sinks against json.dumps, arithmetic against ast, and UDFs from another folder."""

import ast
import csv
import json
import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.functions.python import _arithmetic
from millrace.sources import readers, writers

REPO = Path(__file__).resolve().parent.parent


def rows_of(df):
    return sorted((r.asDict(True) for r in df.collect()), key=str)


def test_csv_like_the_csv_module(spark, tmp_path):
    rows = [["id", "text", "note"], ["1", 'He said "hi"', "a,b"], ["2", "two\nlines", ""], ["3", "", 'x""y'], ["4", "back\\slash", "\\"], ["5", "é 中", " space "], ["6", '"', "null"]]
    path = tmp_path / "a.csv"
    with path.open("w", encoding="utf-8", newline="") as f:
        csv.writer(f, quoting=csv.QUOTE_ALL).writerows(rows)
    with path.open(encoding="utf-8", newline="") as f:
        want = sorted(csv.DictReader(f), key=str)
    assert rows_of(readers.load_records(spark, str(path))) == want
    with path.open("w", encoding="utf-8", newline="") as f:
        csv.writer(f).writerows(rows)
    assert rows_of(readers.load_records(spark, str(path))) == want


@pytest.mark.parametrize("payload, want", [([{"a": 1}, {"a": 2}], [{"a": 1}, {"a": 2}]), ({"examples": [{"a": 1}, {"a": 2}]}, [{"a": 1}, {"a": 2}]), ({"version": 1, "examples": [{"a": 1}], "note": "x"}, [{"a": 1}])])
def test_json_records(spark, tmp_path, payload, want):
    path = tmp_path / "a.json"
    path.write_text(json.dumps(payload, indent=1), encoding="utf-8")
    assert rows_of(readers.load_records(spark, str(path))) == want
    assert rows_of(readers.load_records(spark, str(path), "a long")) == want


def test_lines_that_cannot_be_parsed_stop_the_read(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"a": 1}\n{"a": \n', encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.load_records(spark, str(path), "a long").collect()
    path.write_text('{"a": 1}\n\n{"a": 2}\n', encoding="utf-8")
    assert rows_of(readers.load_records(spark, str(path))) == [{"a": 1}, {"a": 2}]


def test_other_suffixes_and_no_sources(spark):
    with pytest.raises(ValueError, match="xml"):
        readers.load_records(spark, "a.xml")
    with pytest.raises(ValueError):
        readers.load_all(spark, [])


NESTED = [
    {"id": "b", "z": {"y": 1, "a": None, "m": [{"q": 2, "b": "x: {1, 2}"}, None]}, "text": 'quote " and \\ , : \n tab\t é 中 </a>', "k": None},
    {"id": "a", "z": None, "text": "", "k": True},
    {"id": "c", "z": {"y": -5, "a": "s", "m": []}, "text": "[,]", "k": False},
]
KIND = "k boolean, text string, z struct<y: long, a: string, m: array<struct<q: long, b: string>>>, id string"


def test_json_lines_like_sorted_dumps(spark, tmp_path):
    df = spark.createDataFrame(NESTED, KIND)
    writers.write_jsonl(df.repartition(2), str(tmp_path / "out"))
    lines = sorted(line for f in (tmp_path / "out").glob("part-*") for line in f.read_text(encoding="utf-8").splitlines())
    assert lines == sorted(json.dumps(r, sort_keys=True, ensure_ascii=False) for r in NESTED)
    with_map = spark.createDataFrame([(1, {"b": 2, "a": None, "c": 1})], "n long, m map<string, long>")
    assert with_map.select(writers.json_lines(with_map)).first()[0] == '{"m": {"a": null, "b": 2, "c": 1}, "n": 1}'


def test_checksum_changes_with_any_field(spark, monkeypatch):
    rows = [(str(k), f"text {k}", k % 3) for k in range(200)]
    frame = lambda x: spark.createDataFrame(x, "id string, text string, n int")
    whole = writers.checksum(frame(rows))
    assert writers.checksum(frame(rows[::-1]).repartition(5)) == whole
    swapped = [*rows]
    swapped[3], swapped[4] = (rows[3][0], rows[4][1], rows[3][2]), (rows[4][0], rows[3][1], rows[4][2])
    assert len({whole, writers.checksum(frame(swapped)), writers.checksum(frame(rows[1:])), writers.checksum(frame([*rows, rows[0]]))}) == 4
    monkeypatch.setattr(writers, "PART_ROWS", 30)
    parts = writers.part_digests(frame(rows)).collect()
    assert len(parts) == 7 and sum(p["rows"] for p in parts) == 200
    assert writers.checksum(frame(rows[::-1]).repartition(5)) == writers.checksum(frame(rows)) != writers.checksum(frame(swapped))
    assert writers.checksum(frame([])) == writers.checksum(frame([]).repartition(3))


def test_manifest(spark, tmp_path):
    df = spark.createDataFrame(NESTED, KIND)
    found = writers.write_manifest(df, {"name": "x"}, str(tmp_path / "manifest"))
    (part,) = (tmp_path / "manifest").glob("part-*")
    assert json.loads(part.read_text()) == found == {"name": "x", "checksum": writers.checksum(df), "examples": 3}


def python_value(text):
    """What Python makes of + - * / on plain numbers, or None if it is anything else."""
    try:
        tree = ast.parse(text.strip(), mode="eval")
    except (SyntaxError, ValueError):
        return None
    fine = (ast.Expression, ast.BinOp, ast.Add, ast.Sub, ast.Mult, ast.Div, ast.Constant)
    if not all(isinstance(n, fine) for n in ast.walk(tree)):
        return None
    try:
        return str(eval(compile(tree, "", "eval")))
    except ArithmeticError as error:
        return type(error).__name__


def test_arithmetic_on_malformed_input():
    r = random.Random(1)
    texts = ["1+", "+1", "(", ")", "()", "1+(", "(1", "1)", "*", "1**2", "1//2", "1 2", "", " ", "1/0", "2*(3+4)", "1.5+2", "((((1))))", "1-1-1", "8/4/2", "1+)", "(+)", "1 + 2 )", "a", "1e", "1,2"]
    texts += ["".join(r.choice("12 +-*/().") for _ in range(r.randint(1, 9))) for _ in range(600)]
    got = _arithmetic(__import__("pandas").Series(texts))
    for text, value, error in zip(texts, got["value"], got["error"]):
        want = python_value(text)
        assert (value if value is not None else error if error == "ZeroDivisionError" else None) == want, text


SCRIPT = """
import os, sys
sys.path.insert(0, {repo!r})
os.chdir({away!r})
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local-cluster[1,1,1024]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1").config("spark.executorEnv.PYTHONPATH", "").getOrCreate()
from millrace.functions import python as P
df = spark.createDataFrame([("1 + 2", "x = 1", 'so {{"a": 1}}', "A\\u0301")], "a string, b string, c string, d string")
print("GOT", df.select(P.arithmetic("a")["value"], P.compiles("b"), P.first_json_object("c")).first())
spark.stop()
"""


def test_functions_reach_executors_that_lack_the_package(tmp_path):
    """A cluster whose executor starts elsewhere, with a driver in another folder."""
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(repo=str(REPO), away=str(tmp_path)), encoding="utf-8")
    done = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=240, cwd=tmp_path)
    if "GOT" not in done.stdout and "local-cluster" in done.stderr and "SPARK_HOME" in done.stderr:
        pytest.skip("no local cluster here")
    assert "GOT Row" in done.stdout and "'3'" in done.stdout.replace("value='3'", "'3'"), done.stderr[-1500:]


def test_file_digests(spark, tmp_path):
    import hashlib

    (tmp_path / "a.bin").write_bytes(b"abc")
    assert readers.file_digests(spark, str(tmp_path)).select("sha256").first()[0] == hashlib.sha256(b"abc").hexdigest()
    assert readers.text_files(spark, str(tmp_path)).select(F.col("value")).first()[0] == "abc"
