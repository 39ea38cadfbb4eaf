"""The pipeline on a small fixture, stage by stage, against brute force."""

import random

import corpus_pipeline
from millrace.llm.tables import written


def test_stages(spark, tmp_path):
    r = random.Random(8)
    made = {"aa": ["kli", "por", "ten", "va"], "bb": ["zu", "wax", "qem", "ol"]}
    text = lambda k, n: " ".join("".join(r.choice(made[k]) for _ in range(r.randint(2, 5))) for _ in range(n))
    rows = [(i, text(k, 60), k, f"s{i % 3}") for i in range(120) for k in [("aa", "bb")[i % 2]]]
    item = text("aa", 20)
    rows += [(200, rows[0][1], "aa", "s0"), (201, rows[1][1] + " more", "bb", "s1"), (202, text("aa", 30) + " " + item + " " + text("aa", 9), "aa", "s2"), (203, None, "aa", "s0"), (204, "123 !!", "aa", "s0")]
    rows += [(None, text("aa", 40), "aa", "s0"), (None, text("bb", 7), "bb", None), (7, text("bb", 90), "bb", "s1")]  # no id twice, and an id again
    clash = ("score", "lang_pred", "has_letter", "spans", "mark", "size", "block", "digest")  # columns that the stages have names for, too
    docs = spark.createDataFrame([(*x, len(x[1] or ""), *clash) for x in rows], "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"{c} string" for c in clash))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept, now = [], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = written(stage(spark, now, str(tmp_path)), "test")
        assert now.dtypes == docs.dtypes, name
        assert all(x[c] == c for x in now.collect() for c in clash), name
        kept.append({x.doc_id for x in now.select("doc_id").collect()})
    assert kept[0] == {x[0] for x in rows} - {203, 204}
    assert kept[1] == kept[0] - {200, 201}
    assert kept[2] == kept[1] - {202}
    assert kept[3] <= kept[2]
    # the mix takes whole words in their order, from a text of its own row; two texts without an id stay two
    texts = {}
    for x in rows:
        texts.setdefault(x[0], []).append((x[1] or "").split())
    inside = lambda part, whole: any(whole[k : k + len(part)] == part for k in range(len(whole) - len(part) + 1))
    for x in now.collect():
        assert x.n_chars == len(x.text) and x.text, x
        assert any(all(inside(part.split(), t) for part in x.text.split("\n")) for t in texts[x.doc_id]), x
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {d for x in final for d in x.doc_ids} == kept[3]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
