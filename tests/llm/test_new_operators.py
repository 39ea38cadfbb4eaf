"""Packing, whitening and hard negatives against brute force: nulls, repeats, ties, empty tables, clashing columns, long texts, hot groups."""

import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import negatives, packing, queries, whitening

CONFIG = packing.public_pack_config()
WORDS = packing.WordIds(open(CONFIG.vocabulary, encoding="utf-8").read(), CONFIG)
MODEL = Tokenizer.from_file(CONFIG.vocabulary)


def ids_of(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return WORDS.encode(raw, np.array([0, len(raw)]))[0].tolist()


def test_chunks_have_the_ids_of_their_texts():
    texts = ["It's", "", "'s", "d'", "'", "s", "a<", "|b", "caf\u00e9 \u017f\u0178\u013f", "'re'RE 're", "\u4e2d it's", "12'd 3", "'", "ll", "x'l", "l"]
    raw = [t.encode() for t in texts]
    got = WORDS.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert [x.tolist() for x in got] == [MODEL.encode(t, add_special_tokens=False).ids for t in texts]


# packing


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t\r'sStTdm.,!?0123éÉßİıÅǺΣσ<|endoftext|>")), max_size=60))
def test_words_have_the_ids_of_the_whole_text(text):
    assert ids_of(text) == MODEL.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["it's O'Neil'S we'll 'd''s", "a<|endoftext|>b <|startoftext|>", "x" * 5000 + " end", "naïve ÀÉ Straße İstanbul ɏȺ", "é é", "a b c\x85d\x1ce", "100 2³ ½ ١٢", "中文字 かな 한글", "ͅ ͅa"])
def test_words_of_chosen_texts(text):
    assert ids_of(text) == MODEL.encode(text, add_special_tokens=False).ids


def test_a_small_cache_forgets_and_stays_right():
    from dataclasses import replace

    words = packing.WordIds(open(CONFIG.vocabulary, encoding="utf-8").read(), replace(CONFIG, cache=3))
    text = "the quick Brown fox, jumps over the lazy dog; the quick dog."
    for _ in range(3):
        raw = np.frombuffer(text.encode(), np.uint8)
        assert words.encode(raw, np.array([0, len(raw)]))[0].tolist() == MODEL.encode(text, add_special_tokens=False).ids
    assert len(words.slot) < 14


def packed_rows(spark, rows, config):
    docs = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], "doc_id long, text string, key string, length int, sequence_id int").repartition(3)
    packed = packing.pack(docs, config)
    return packed, packed.table().collect()


def check_packed(rows, got, config):
    """Every document's pieces are its ids, every sequence is gapless and not too long."""
    want = sorted(((d is not None, d), tuple((MODEL.encode(t, add_special_tokens=False).ids if t else []) + [config.end])) for d, t in rows)
    want = sorted(((d[0], d[1] or 0), i, ids[low : low + config.length], low) for d, ids in want for i, low in enumerate(range(0, len(ids), config.length)))
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.piece, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.start) for r in got) == want
    assert all(r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in got)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, size in sorted(spans):
            assert offset == at
            at += size
        assert at <= config.length
    return len(by)


def best_fit_decreasing(sizes, length):
    gaps = []
    for n in sorted(sizes, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            gaps.append(length - n)
        else:
            gaps.remove(fit)
            gaps.append(fit - n)
    return len(gaps)


def test_packing_against_brute_force(spark):
    r = random.Random(3)
    config = packing.PackConfig(CONFIG.vocabulary, length=64)
    words = ["the", "of", "stone", "river", "Éclair", "unfathomable", "x,", "7"]
    rows = [(k, " ".join(r.choice(words) for _ in range(r.choice([1, 2, 3, 8, 20, 33, 60, 150])))) for k in range(400)]
    rows += [(None, "a b c"), (None, None), (7, ""), (7, rows[7][1]), (500, " \n "), (501, "river " * 3000)]
    rows += [(1000 + k, "the same words again") for k in range(200)]  # one length holds a third of all rows
    packed, got = packed_rows(spark, rows, config)
    n = check_packed(rows, got, config)
    sizes = [x.length for x in got]
    assert -(-sum(sizes) // 64) <= n <= math.ceil(best_fit_decreasing(sizes, 64) * 1.01)
    whole = {x.sequence_id: x for x in packed.sequences().collect()}
    assert len(whole) == n
    for x in got:
        assert bytes(whole[x.sequence_id].ids)[4 * x.offset : 4 * (x.offset + x.length)] == bytes(x.ids)
        assert (x.offset, x.doc_id, x.piece, x.length) in [tuple(p) for p in whole[x.sequence_id].pieces]


@pytest.mark.parametrize("sizes", [[], [64], [64] * 5, [33] * 40, [32] * 41, [22] * 100, [1] * 1000, [63, 1, 1, 62, 2, 60, 3], [*range(1, 65)] * 6, [40] * 30 + [3] * 900, [21] * 90 + [25] * 90])
def test_places_of_given_lengths(spark, sizes):
    config = packing.PackConfig(CONFIG.vocabulary, length=64)
    pieces = spark.createDataFrame([(k, n) for k, n in enumerate(sizes)], "key long, length int").repartition(4)
    places, rounds = packing.place(pieces, config)
    got = {r.key: r for r in places.collect()}
    assert sorted(got) == list(range(len(sizes)))
    by = {}
    for k, n in enumerate(sizes):
        by.setdefault(got[k].sequence_id, []).append((got[k].offset, n))
    assert all(sum(n for _, n in x) <= 64 and [a for a, _ in sorted(x)] == [sum(n for _, n in sorted(x)[:i]) for i in range(len(x))] for x in by.values())
    assert len(by) <= math.ceil(1.02 * best_fit_decreasing(sizes, 64)) and rounds <= 40


def test_sweeps_match_like_one_sorted_list():
    """Dealt over parts or not, each gap takes the largest free piece that fits, in order of the gaps."""
    r = random.Random(4)
    for _ in range(200):
        events = sorted((r.randint(1, 9), r.randint(0, 1), k) for k in range(r.randint(0, 30)))
        free, want = [], set()
        for value, kind, k in events:
            if kind == packing.PIECE:
                free.append(k)
            elif free:
                want.add((free.pop(), k))
        cuts = sorted(r.randint(0, len(events)) for _ in range(3))
        got, left, counts = set(), {}, {}
        for part, (low, high) in enumerate(zip([0, *cuts], [*cuts, len(events)])):
            stack, gaps = [], []
            for value, kind, k in events[low:high]:
                if kind == packing.PIECE:
                    stack.append(k)
                elif stack:
                    got.add((stack.pop(), k))
                else:
                    gaps.append(k)
            left[part], counts[part] = (gaps, stack), (len(gaps), len(stack))
        runs, stay = packing.runs_between(counts)
        for source, low, high, to, first in runs:
            got |= {(left[source][1][rank], left[to][0][first + high - 1 - rank]) for rank in range(low, high)}
        assert got == want
        assert sum(stay.values()) == len(free)


def test_packing_an_empty_table(spark):
    packed, got = packed_rows(spark, [], CONFIG)
    assert got == [] and packed.sequences().collect() == []


# whitening


def brute_components(vectors, k):
    x = np.unique(np.array(vectors, np.int64), axis=0)
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    return n, s, e[::-1][:k], v[:, ::-1][:, :k], e.sum()


def test_whitening_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 6)) * [5, 4, 3, 2, 1, 0.5] @ np.linalg.qr(rng.standard_normal((6, 6)))[0]
    rows = [(k, v.tolist()) for k, v in enumerate(base)] + [(500 + k, base[0].tolist()) for k in range(150)]
    rows += [(None, base[1].tolist()), (3, base[3].tolist()), (700, None), (701, [1.0, None] * 3), (702, [math.nan] * 6), (703, [math.inf] * 6), (704, []), (705, [1e300] * 6)]
    rows += [(710, [1.0, 2.0]), (711, [1.0, 2.5]), (712, [3.0]), (713, [3.0])]
    frame = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "vec_id long, embedding array<double>, n int, component string").repartition(3)
    for guard in (8, 1):
        out = whitening.whiten(frame, whitening.WhitenConfig(components=4, guard=guard))
        got = out.rows.collect()
        sound = [(k, np.floor(64 * np.array(v)).astype(np.int64) + 1_000_000) for k, v in rows if v and len(v) == 6 and all(c is not None and abs(c) < 1e9 for c in v)]
        n, s, e, v, trace = brute_components([x for _, x in sound], 4)
        assert out.components[6].values == pytest.approx(e, rel=1e-12)
        assert np.abs((out.components[6].vectors * v).sum(axis=0)) == pytest.approx(np.ones(4), abs=1e-10)
        six = [r for r in got if r.n == n]
        assert len(six) == 4 * len(sound)
        signs = np.sign((out.components[6].vectors * v).sum(axis=0))
        expected = sorted((k is None, k or 0, c + 1, sum(int(n * a - b) ** 2 for a, b in zip(x.tolist(), s.tolist())), float((n * x - s) / n @ v[:, c] * signs[c] / np.sqrt(e[c]))) for k, x in sound for c in range(4))
        for a, b in zip(sorted((r.vec_id is None, r.vec_id or 0, r.component, int(r.deviation), r.whitened) for r in six), expected):
            assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], abs=1e-8)
        assert all(r.explained == pytest.approx(e[r.component - 1] / trace, rel=1e-9) and r.identity_error < 1e-9 for r in six)
        assert {r.vec_id for r in got if r.n == 2} == {710, 711} and not any(r.vec_id in (712, 713) for r in got)  # one dimension varies; one vector does not


def test_whitening_equal_eigenvalues_and_no_rows(spark):
    rows = [(k, v) for k, v in enumerate([[1.0, 0.0, 0.0], [-1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, -1.0, 0.0]])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(frame)
    assert got.components[3].values == pytest.approx([2048, 2048]) and got.rows.count() == 8
    assert whitening.whiten(frame.where("vec_id < 0")).rows.collect() == []
    assert whitening.whiten(frame.where("vec_id = 0")).rows.collect() == []


def test_deviations_stay_exact_beyond_64_bits():
    m = whitening.Moments(3, [9, 3 << 55])
    x = np.array([[1, (1 << 56) + 1], [5, 7]], np.int64)
    assert whitening.squares(m.deviations(x)) == [(3 * 1 - 9) ** 2 + (3 * ((1 << 56) + 1) - (3 << 55)) ** 2, (15 - 9) ** 2 + (21 - (3 << 55)) ** 2]
    assert Fraction(whitening.squares(np.array([[1 << 40, 1]], np.int64))[0]) == (1 << 80) + 1


def test_whitening_query(spark):
    got = queries.op12_embedding_whitening(spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes)["deviation"] == "bigint" and got.count() == 16 * 500


# hard negatives


def brute_negatives(rows, anchor, config):
    seen = sorted({(k, label, tuple(math.floor(config.scale * c) for c in v)) for k, v, label in rows if k is not None and label is not None and v and all(c is not None and math.isfinite(c) and abs(c) < 1e5 for c in v)})
    out = []
    for a in seen:
        if not anchor(a[0]):
            continue
        near = sorted(((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1], b[2]) for b in seen if b[0] != a[0] and len(b[2]) == len(a[2])))
        for p in [b for b in near if b[2] == a[1]][: config.positives]:
            fit = [b for b in near if b[2] != a[1] and config.low * -p[0] <= 100 * -b[0] <= config.high * -p[0]][: config.negatives]
            out += [(a[0], p[1], k + 1, b[1], -p[0], -b[0]) for k, b in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, anchors, config, kind="int"):
    frame = spark.createDataFrame([(k, v, label, 0, "x") for k, v, label in rows], f"vec_id long, embedding array<double>, label {kind}, row int, x string").repartition(3)
    return sorted(tuple(r) for r in negatives.mine(frame, anchors, config).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_hard_negatives_against_brute_force(spark):
    rng = np.random.default_rng(6)
    middle = rng.standard_normal((5, 12))
    rows = [(k, (middle[k % 5] + 0.4 * rng.standard_normal(12)).tolist(), int(rng.integers(0, 4)) if k % 3 else 1) for k in range(500)]
    rows += [(600 + k, rows[0][1], k % 3) for k in range(40)]  # ties
    rows += [rows[10], rows[20], (30, rows[31][1], 2), (None, rows[1][1], 1), (700, None, 1), (710, rows[1][1], None), (720, [math.nan] * 12, 1), (730, [1.0, None] * 6, 1), (740, [], 1), (750, [1e9] * 12, 1), (760, [0.0] * 12, 1), (770, [-3.0] * 12, 9)]
    rows += [(800 + k, rng.standard_normal(3).tolist(), k % 2) for k in range(30)]  # vectors of another length
    for config in (negatives.NegativeConfig(sample=200, centres=8, parts=4, block=7, rows=64), negatives.NegativeConfig(positives=2, negatives=3, low=95, parts=20)):
        want = brute_negatives(rows, lambda k: k % 10 == 0, config)
        assert len(want) > 100
        assert mined(spark, rows, F.col("vec_id") % 10 == 0, config) == want


def test_hard_negatives_of_nothing(spark):
    config = negatives.NegativeConfig()
    one = [(0, [1.0, 2.0], "a"), (1, [1.0, 2.0], "b")]
    assert mined(spark, [], F.col("vec_id") == 0, config) == []
    assert mined(spark, one, F.col("vec_id") == 0, config, "string") == []  # no positive
    assert mined(spark, one, F.col("vec_id") == 9, config, "string") == []  # no anchor
    assert mined(spark, [*one, (2, [1.0, 2.0], "a")], F.col("vec_id") == 0, config, "string") == [(0, 2, 1, 1, 327680, 327680)]


def test_lookup_bounds_hold():
    rng = np.random.default_rng(7)
    config = negatives.NegativeConfig(parts=3, centres=4)
    x = rng.integers(-300, 300, (200, 8))
    centres = negatives.fit_centres(x[:50], config)
    block = negatives.Block.of(np.arange(5), np.ones(5, int), np.zeros(5, int), x[:5], centres)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(200)), pa.array(np.ones(200, int)), pa.array(np.zeros(200, int)), pa.array(x.tolist(), pa.list_(pa.int64()))], names=["vec_id", "row", "kind", "x"])
    coded = list(negatives.encode_rows(centres)([batch]))
    rows = [(score, off) for _, _, _, _, score, off in negatives.scored(coded, block, config)]
    score, off = (np.concatenate(v) for v in zip(*rows))
    true = x @ x[:5].T
    assert (np.abs(score - true) <= off).all() and off.mean() < np.abs(x).sum(axis=1).mean() * 300
