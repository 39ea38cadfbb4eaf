"""What op7 holds on the driver while it learns."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import toxicity
from millrace.llm import vectors as V


def sample(n):
    """Texts with about n distinct words, a fourth of them with one of three toxic words."""
    r = random.Random(4)
    texts = [" ".join("".join(r.choice("abcdefghiklmnoprstuvwz") for _ in range(7)) for _ in range(50)) for _ in range(n // 50)]
    return [t + " " + r.choice(["zogrik", "mufwad", "kwibbel"]) if i % 4 == 0 else t for i, t in enumerate(texts)], [int(i % 4 == 0) for i in range(len(texts))]


def peak(texts, labels):
    tracemalloc.start()
    model = toxicity.train(texts, labels, toxicity.ToxicConfig(near=0.0, rounds=2))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most / 1e6, model.scores(*V.buffers(pa.array(["zogrik", "x mufwad", texts[1], None])))


def test_rows_of_the_map_are_not_held_for_every_word(monkeypatch):
    texts, labels = sample(16_000)
    plain = peak(texts, labels)[1]
    monkeypatch.setattr(toxicity, "BLOCK", 1024, raising=False)
    monkeypatch.setattr(toxicity, "HELD", 1, raising=False)
    most, scores = peak(texts, labels)
    assert most < 45  # 385 columns of 4 bytes for each word are 25 MB, their copy as doubles 49 more
    assert np.allclose(scores, plain, atol=1e-6) and (scores >= 0.5).tolist() == [True, True, False, False]


@pytest.mark.parametrize("text", ["zog-rik, ZOGRIK zogrik the a an the", None])
def test_the_driver_gets_distinct_words(spark, monkeypatch, text):
    got = []
    monkeypatch.setattr(toxicity, "learn", lambda texts, labels, config: got.extend(zip(texts, labels)), raising=False)
    monkeypatch.setattr(toxicity, "train", lambda texts, labels, config: got.extend(zip(texts, labels)))
    docs = spark.range(20).select(F.col("id").alias("doc_id"), F.lit(text).cast("string").alias("text"))
    toxicity.fit_toxicity(docs, docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic")))
    assert len(got) > 10 and {y for _, y in got} == {0, 1}
    assert {t for t, _ in got} == {b"" if text is None else b"\0".join(bytes(ord(c) - 96 for c in w) for w in ("zogrik", "the"))}


def test_labelled_texts_without_words(spark):
    docs = spark.createDataFrame([(i, [None, "", "a b", "1!"][i % 4]) for i in range(40)], "doc_id long, text string")
    got = toxicity.toxicity(docs, docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))).collect()
    assert sorted(x.doc_id for x in got) == list(range(40)) and all(x.score < 1e-9 and x.predicted == 0 for x in got)
