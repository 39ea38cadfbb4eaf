"""A whole build with its filters on and an evaluation set beside it: every row ends in one place, with the reason."""

import json
from collections import Counter

import pytest

from millrace.operators.quality import QualityConfig
from millrace.plans.build import build

SCHEMA = "id string, domain string, task string, input string, expected_output string, source struct<name:string>, license struct<name:string>, dataset_version string, context string, reasoning string"
LONG = "The river bends twice before it reaches the old mill, and every spring the water rises over the lower meadow and carries the fences away"


def record(i, question, answer, domain="chat"):
    return (i, domain, "sft", question, answer, ("s",), ("mit",), "v1", None, None)


def answer(k):
    words = ["amber", "basil", "cedar", "dune", "ember", "fjord", "grove", "heath", "islet", "juniper", "kelp", "larch"]
    return "It is " + " ".join(words[(k * 5 + j * j + j * k) % 12] + f" number{k}x{j}" for j in range(25)) + " in the end."


ROWS = [record(f"good{k}", f"How many ways lead to place{k} from the valley of rivers?", answer(k)) for k in range(6)]
ROWS += [
    record("near0", "What does the river do in spring?", LONG + " again."),
    record("near1", "What does the river do in spring?", LONG + " again and again."),
    record("near2", "what DOES the river do, in spring?", LONG + ", again!"),
    record("short", "How long is it?", "."),
    record("loop", "Say something about the lake please", "the lake is deep " * 40),
    record("zcopy", ROWS[0][3], ROWS[0][4]),
    record("empty", "", "x"),
    record("leak", "Please tell me in detail how the old clock tower of the town was built and by whom it was paid for", "By the guild of weavers, over the course of eleven years, from stone of the northern quarry."),
]
CASES = [("e1", "Please tell me in detail how the old clock tower of the town was built and by whom it was paid for today", "unknown")]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("build")
    rows = spark.createDataFrame(ROWS, SCHEMA)
    cases = spark.createDataFrame(CASES, "id string, prompt string, expected string")
    manifest = build(rows, str(out), "v1", evaluation=cases, config=QualityConfig(language=False), seed=3)
    read = lambda name: [json.loads(line) for f in sorted((out / name).glob("part-*")) for line in f.read_text(encoding="utf-8").splitlines()]
    return manifest, {name: read(name) for name in ("raw", "train", "rejected", "sft")}


def test_every_row_ends_in_one_place(built):
    manifest, files = built
    train, rejected = {r["id"] for r in files["train"]}, {r["id"]: r for r in files["rejected"]}
    assert not train & rejected.keys() and train | rejected.keys() == {r[0] for r in ROWS} == {r["id"] for r in files["raw"]}
    assert train == {f"good{k}" for k in range(6)} | {"near0"}
    why = {k: r["quality_filter"] or ("duplicate" if r["duplicate_of"] else "validation") for k, r in rejected.items()}
    assert why == {"near1": "near_duplicate", "near2": "near_duplicate", "short": "length", "loop": "repetition", "zcopy": "duplicate", "empty": "validation", "leak": "eval_near_duplicate"}
    assert rejected["near1"]["quality_reason"] == rejected["near2"]["quality_reason"] == "near duplicate of near0" and "e1" in rejected["leak"]["quality_reason"]
    assert len(files["sft"]) == len(train)


def test_reports_of_the_build(built):
    manifest, files = built
    assert manifest["examples"] == 7 and manifest["rejected"] == 7
    report = manifest["quality"]
    assert report["enabled"] and report["removed"] == {"language": 0, "length": 1, "repetition": 1, "near_duplicate": 2}
    assert manifest["eval_near_duplicate"]["removed"] == 1 and manifest["eval_near_duplicate"]["eval_records"] == 1 and manifest["eval_near_duplicate"]["examples"][0]["id"] == "leak"
    assert manifest["statistics"]["domains"] == {"chat": 7} and Counter(r["validation_status"] for r in files["rejected"]) == {"rejected": 7}
    assert json.loads(json.dumps(manifest))["checksum"] == manifest["checksum"]


def test_rows_without_words_are_near_each_other(spark):
    from millrace.plans.build import near_duplicates

    rows = [record("a", "?!", "..."), record("b", "--", "!!!"), record("c", "What now?", LONG), record("d", "What, now", LONG.upper())]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA), QualityConfig())
    assert sorted(tuple(r) for r in got.collect()) == [("b", "a"), ("d", "c")]
