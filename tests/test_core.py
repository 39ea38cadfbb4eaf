import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions.python import arithmetic, compiles, first_json_object
from millrace.operators import cost, formats, mixing, quality, scoring, similarity, validation
from millrace.operators.dedup import exact_dedup
from millrace.operators.synthetic import tool_call_rows


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lit(x):
    return F.lit(x)


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("Tôi rất thích học lập trình vì nó giúp tôi giải quyết nhiều vấn đề khác nhau", "vi"),
        ("toi khong biet cua nhung nguoi trong nay cho minh ban lam nhieu viec cung nhu the", "vi-khong-dau"),
        ("This is the way that we can write what you will have to be in the end", "en"),
        ("这是一个很长的中文句子，用来测试语言检测功能是否能够正确识别其他文字", "other"),
        ("x + y = 3", "unknown"),
    ],
)
def test_language(spark, text, wanted):
    assert one(spark, T.detect_language(lit(text))) == wanted


def test_runs_and_ratios(spark):
    run = lambda s: one(spark, T.longest_word_run(T.words(lit(s))))
    assert run("tôi rất rất rất vui") == 3
    assert run("0 0 0 0 0 x x x a") == 0
    assert one(spark, T.repeated_share(T.ngrams(T.words(lit("a b c a b c")), 3))) == 0.25
    assert one(spark, T.normalize(lit("  Straße\n ẤM "))) == "strasse ấm"
    assert one(spark, T.prose(lit("a ```x``` b \\frac c ```open"))).split() == ["a", "b", "c"]


def test_answers(spark):
    match = lambda a, *e: one(spark, T.answer_matches(lit(a), F.array(*map(F.lit, e))))
    assert match("337.500 đồng", "337500")
    assert not match("187", "87")
    assert not match("87,5", "87")
    assert match("Kết quả: Hà Nội", "hà nội")


@pytest.mark.parametrize("b, c, p", [(0, 4, 0.125), (0, 2, 0.5), (0, 6, 0.03125), (3, 3, 1), (0, 0, 1)])
def test_mcnemar(spark, b, c, p):
    assert one(spark, scoring.mcnemar(lit(b).cast("bigint"), lit(c).cast("bigint"))) == p


def test_secrets(spark):
    shell = lambda s: one(spark, T.has_shell_secret(lit(s)))
    assert one(spark, T.has_secret(lit("hf_" + "a" * 24))) and one(spark, T.has_secret(lit("Password: 12345678")))
    assert shell("DB_PASS=s3cretvalue") and shell("DB_PASS=${X:-s3cret}")
    assert not any(map(shell, ("DB_PASS=$OTHER", "DB_PASS=${OTHER}", "DB_PASS=$1", "bypass=abcdef", "DB_PASS=${X:?unset}")))


def test_python_functions(spark):
    rows = spark.createDataFrame([("1+2*3",), ("1/0",), (None,), ("import os",)], "t string")
    assert [r.r.value for r in rows.select(arithmetic("t").alias("r")).collect()] == ["7", None, None, None]
    assert [r.r for r in rows.select(compiles("t").alias("r")).collect()] == [True, True, True, True]
    assert spark.createDataFrame([("x <think>{\"a\":1}</think> ```json\n{\"b\": 2}\n```",)], "t string").select(first_json_object("t")).first()[0] == '{"b": 2}'


def test_messages_and_formats(spark):
    valid = lambda m: one(spark, validation.valid_messages(F.array(*[F.struct(F.lit(r).alias("role"), F.lit(c).alias("content")) for r, c in m])))
    assert valid([("user", "q"), ("assistant", "a")])
    assert not valid([("user", "q")]) and not valid([("assistant", "a")]) and not valid([("user", " "), ("assistant", "a")])
    row = spark.createDataFrame([("1", "q", "a", "c", "r")], "id string, input string, expected_output string, context string, reasoning string")
    got = formats.prepare(row, "sft").first().messages
    assert [m.content for m in got] == ["c\n\nq", "<think>\nr\n</think>\n\na"]
    with pytest.raises(ValueError):
        formats.prepare(row, "other")


def test_dedup_and_keep_first(spark):
    rows = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y")], "id long, h string")
    assert {r.id: r.duplicate_of for r in exact_dedup(rows, "id", "h").collect()} == {1: None, 2: None, 3: 1}
    chain = spark.createDataFrame([(1, 2), (2, 3), (4, 5)], "a long, b long")
    assert {r.id: r.partner for r in similarity.keep_first(chain).collect()} == {1: None, 2: 1, 3: None, 4: None, 5: 4}


def test_similarity_join_against_brute_force(spark):
    import random

    r = random.Random(1)
    texts = [[r.choice("abcdefgh") for _ in range(r.randint(0, 14))] for _ in range(60)]
    texts += [t[:-1] + ["z"] for t in texts[:20] if t]
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "id long, text string")
    got = {(x.a, x.b) for x in similarity.similar_pairs(similarity.shingle_sets(rows, "id", F.col("text")), None, 0.5).collect()}
    sets = [{tuple(t[k : k + 3]) for k in range(len(t) - 2)} if len(t) > 2 else ({tuple(t)} if t else set()) for t in texts]
    want = {(i, j) for j in range(len(sets)) for i in range(j) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.5 * len(sets[i] | sets[j])}
    assert got == want


def test_candidates_are_all_pairs_of_a_bucket(spark):
    """Texts 2 and 3 meet only in a bucket that another text leads."""
    rows = [(1, [1, 1, 2, 2]), (2, [1, 1, 3, 3]), (3, [1, 1, 4, 4]), (4, [9, 9, 9, 9])]
    signs = spark.createDataFrame([(i, k, v) for i, s in rows for k, v in enumerate(s)], "id long, slot int, value long")
    got = [(r.a, r.b) for r in similarity.band_candidates(signs, 4, 2).collect()]
    assert sorted(got) == [(1, 2), (1, 3), (2, 3)]


def test_mixes(spark):
    rows_of = lambda plan: dict(zip(plan["name"], plan["rows"]))
    assert rows_of(mixing.plan_mix({"a": 0.4, "b": 0.3, "c": 0.3}, {"a": 1000, "b": 1000, "c": 1000})) == {"a": 1000, "b": 750, "c": 750}
    assert rows_of(mixing.plan_mix(mixing.parse_mix(["x"]), {"x": 5000}, 2000, 0.1)) == {"x": 1800, "synthetic": 200}
    assert rows_of(mixing.plan_mix({"x": 1.0}, {"x": 900}, None, 0.1)) == {"x": 900, "synthetic": 100}
    assert dict(mixing.parse_mix(["a:1", "b:3"])) == {"a": 0.25, "b": 0.75}
    for wrong in ([], ["a", "a"], [":2"], ["a:x"], ["a:"] * 2):
        with pytest.raises(ValueError):
            mixing.parse_mix(wrong)
    with pytest.raises(ValueError):
        mixing.plan_mix({"x": 1.0}, {"x": 900}, 1000)
    with pytest.raises(ValueError):
        mixing.parse_mix(["a:0"])
    rows = spark.range(100).select(F.col("id"), F.when(F.col("id") < 80, "a").otherwise("b").alias("g"))
    assert {x.g: x["count"] for x in mixing.sample(rows, "g", "id", {"a": 0.5, "b": 0.5}, 1).groupBy("g").count().collect()} == {"a": 20, "b": 20}
    made = tool_call_rows(spark, 200, 17, (14,)).collect()
    assert len({x.prompt for x in made}) == 200 and not any(" 14 " in x.prompt for x in made)


def test_cost(spark):
    assert abs(one(spark, cost.training_gb(lit(4.02), lit("4bit"), lit(2048))) - 9.18) < 0.01
    m = F.array(F.struct(F.lit("x" * 34).alias("content")), F.struct(F.lit("y" * 68).alias("content")))
    assert one(spark, cost.row_tokens(m, 1024)) == 40
    with pytest.raises(ValueError):
        quality.QualityConfig(permutations=100, bands=32)


def test_build(spark, tmp_path):
    from millrace.plans.build import EvalOverlap, build

    record = lambda i, q, a: (i, "chat", "sft", q, a, ("s",), ("mit",), "v1", None, None)
    schema = "id string, domain string, task string, input string, expected_output string, source struct<name:string>, license struct<name:string>, dataset_version string, context string, reasoning string"
    rows = spark.createDataFrame([record("a", "what is the first", "one two"), record("b", "what is the first", "one two"), record("c", "tell me of the second", "two"), record("d", "", "x")], schema)
    manifest = build(rows, str(tmp_path / "out"), "v1")
    assert manifest["examples"] == 2 and manifest["rejected"] == 2
    assert manifest["statistics"]["duplicate_rate"] == 1 / 3 and manifest["statistics"]["domains"] == {"chat": 2}
    with pytest.raises(EvalOverlap):
        build(rows, str(tmp_path / "two"), "v1", evaluation=spark.createDataFrame([record("z", "What is the FIRST?", "no")], schema))


def test_stream(spark, tmp_path):
    from millrace.streaming.stream import clean_stream, run_once

    schema = "id string, text string, arrived timestamp"
    rows = [("1", "hello there", "2024-01-01 00:00:00"), ("2", "Hello  there", "2024-01-01 00:00:01"), ("3", "spam " * 20, "2024-01-01 00:00:02")]
    spark.createDataFrame(rows, "id string, text string, arrived string").coalesce(1).write.json(str(tmp_path / "in"))
    run_once(clean_stream(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_plans_of_runs(spark):
    """The two measured runs, one without figures of its own, and one on an unknown device."""
    base = dict(params_b=0.49, precision="4bit", rows=2000, tokens_per_row=None, length=1024, batch=4, accumulation=4, epochs=1, max_steps=0, checkpointing=True, done=0, cases=30, new_tokens=512, device="NVIDIA Tesla T4")
    runs = [base, {**base, "params_b": 4.02, "rows": 1520, "length": 2048, "batch": 1, "accumulation": 16, "done": 30}, {**base, "rows": None, "max_steps": 7, "done": 9}, {**base, "device": "other"}, {**base, "length": 4096}]
    names = list(base)
    kinds = "params_b double, precision string, rows long, tokens_per_row double, length long, batch long, accumulation long, epochs long, max_steps long, checkpointing boolean, done long, cases long, new_tokens long, device string"
    a, b, c, d, e = cost.estimate(spark.createDataFrame([tuple(r[n] for n in names) for r in runs], kinds).coalesce(1)).collect()
    assert (a.rows, a.steps, a.tokens_per_row, a.done_steps) == (2000, 125, 820, 0) and abs(a.train_minutes - 2 * 0.49e9 * 125 * 16 * 820 * 3 / 5.2e12 / 60) < 1e-9 and a.fits
    assert (b.steps, b.done_steps, b.tokens_per_row) == (95, 30, 558) and abs(b.remaining_minutes / b.train_minutes - 65 / 95) < 1e-12 and abs(b.vram_gb - 9.18) < 0.01
    assert (c.rows, c.steps, c.done_steps, c.remaining_minutes) == (2000, 7, 7, 0)
    assert d.train_minutes is None and d.fits is None and d.steps == 125 and d.vram_gb == a.vram_gb
    assert e.fits is False and e.tokens_per_row == 552
