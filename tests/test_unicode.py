"""Normalisation and folding against Python's Unicode tables: all characters alone, and letters of every script with every mark."""

import re
import unicodedata as U

from pyspark.sql import functions as F

from millrace.functions import text as T

ASSIGNED = [chr(c) for c in range(0x110000) if U.category(chr(c)) not in ("Cn", "Cs", "Co")]
PAIRS = [d for c in ASSIGNED if len(d := U.decomposition(c).split()) == 2 and not d[0].startswith("<")]
SECOND = {chr(int(d[1], 16)) for d in PAIRS} | {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}


def test_the_plain_class_follows_from_the_tables():
    plain = [c for c in map(chr, range(0x10000)) if re.match(f"[{T.PLAIN}]", c)]
    assert len(plain) > 30000
    for c in plain:
        assert U.normalize("NFC", c) == c and not U.combining(c) and c not in SECOND, hex(ord(c))
        assert c.casefold() == c.lower().replace("ß", "ss"), hex(ord(c))


def check(spark, texts, column, wanted):
    rows = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
    got = rows.select("t", column(F.col("t")).alias("v")).collect()
    assert len(got) == len(texts)
    assert [hex(ord(r.t[0])) for r in got if r.v != wanted(r.t)] == []


def test_every_character_alone(spark):
    check(spark, ASSIGNED, T.nfc, lambda t: U.normalize("NFC", t))
    check(spark, ASSIGNED, T.fold, str.casefold)
    check(spark, [f" {c}\n{c} " for c in ASSIGNED], T.normalize, lambda t: " ".join(U.normalize("NFC", t).casefold().split()))


def test_letters_with_every_mark(spark):
    marks = sorted(SECOND | {c for c in ASSIGNED if U.combining(c)})
    letters = sorted({chr(int(d[0], 16)) for d in PAIRS} | {c for c in ASSIGNED if U.normalize("NFC", c) != c} | {chr(c) for c in range(0xAC00, 0xD7A4, 997)} | set(ASSIGNED[::199]))
    once = [" ".join(a + m for m in marks) for a in letters]
    check(spark, once, T.nfc, lambda t: U.normalize("NFC", t))
    # two marks in both orders, so that some have to be reordered before they compose
    some = [m for m in marks if U.combining(m)][::40] + ["̇", "̣", "́", "̂"]
    twice = [" ".join(a + m + n for m in some for n in some) for a in letters]
    check(spark, twice, T.normalize, lambda t: " ".join(U.normalize("NFC", t).casefold().split()))


def test_forms_named_in_reviews(spark):
    pairs = [("آ", "آ"), ("ऩ", "ऩ"), ("각", "각"), ("q̣̇", "q̣̇"), ("ﬁ", "fi"), ("ΌΣΟΣ", "όσοσ"), ("Å", "å"), ("ẤM", "ấm")]
    for text, wanted in pairs:
        got = spark.createDataFrame([(U.normalize("NFD", text),), (text,)], "t string").select(T.normalize(F.col("t")).alias("v")).distinct().collect()
        assert [r.v for r in got] == [U.normalize("NFC", U.normalize("NFC", wanted).casefold())]
    assert spark.range(1).select(T.normalize(F.lit(None).cast("string"))).first()[0] == ""
