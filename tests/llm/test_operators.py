"""Each operator against a brute-force version, an exact round trip or held-out accuracy, with nulls, empties, ties, repeats and extra columns."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate, embeddings, graph, html, language, lines, minhash, mixing, suffixes, tokens, toxicity
from millrace.llm import vectors as V

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


@pytest.fixture(scope="module")
def docs(spark):
    """Random texts with copies, near copies, shared passages, nulls, empties, one word, a long one, and extra columns."""
    r = random.Random(4)
    words = [f"w{i}" for i in range(800)]
    some = lambda n: [r.choice(words) for _ in range(n)]
    passage, line = some(70), " ".join(some(12)) + "."
    rows = [(i, " ".join(some(r.randint(1, 120)))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(10)]
    for i in range(12):
        t = rows[20 + i][1].split()
        t[r.randrange(len(t))] = "changed"
        rows.append((200 + i, " ".join(t).upper() if i % 2 else " ".join(t)))
    rows += [(300 + i, " ".join(some(30) + passage + some(20))) for i in range(4)]
    rows += [(400 + i, f"{' '.join(some(15))}\n{line}\n{' '.join(some(9))}.") for i in range(5)]
    rows += [(500, None), (501, ""), (502, " \n\t "), (503, "one"), (504, "é ü"), (505, " ".join(some(5000)))]
    full = [(i, t, ("s1", "s2", None)[i % 3] if i < 400 else "s0", "en", len(t or ""), "clash") for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, source string, lang string, n_chars long, size string").repartition(5).cache()


def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def test_feistel_is_a_bijection():
    for n in (1, 2, 3, 17, 64, 1000):
        there = V.feistel(np.arange(n), n, 99)
        assert sorted(there) == list(range(n))
        assert (V.unfeistel(there, n, 99) == np.arange(n)).all()


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 5), (None, 1)] + [(k, k + 1) for k in range(20, 60)], "a long, b long")
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8} | {k: 20 for k in range(20, 61)}
    assert graph.components(links.limit(0)).count() == 0


def test_mixing(spark, docs):
    config = mixing.MixConfig(block=32, shard_slots=16)
    rows = mixing.mix_sources(docs, config).documents.collect()
    by, sizes = {}, {d: len(WORD.findall(t or "")) for d, t in texts(docs).items()}
    for r in rows:
        assert r["size"] == sizes[r.doc_id]
        assert 0 <= r.taken <= 2 * r["size"]
        by.setdefault(r.source_ix, []).append(r)
    assert len(rows) == docs.count()
    for group in by.values():
        assert sum(r["size"] for r in group) == group[0].source_size
        assert abs(sum(r.taken for r in group) - group[0].target) <= 1
    again = mixing.mix_sources(docs.repartition(3), config).documents.collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)
    mixed = mixing.mixed_documents(docs, config)
    assert mixed.columns == docs.columns
    assert sum(len(WORD.findall(r.text)) for r in mixed.collect()) == sum(r.taken for r in rows)
    assert mixing.mix_sources(docs.limit(0)).documents.count() == 0


def test_html():
    page = "<html><head><title>t</title><style>p{}</style></head><body><nav><a href=x>menu</a></nav><div class=ad>buy now</div><article><h1>A &amp; B</h1><p><b>one\n two<br><p>three</article><div id='comments'>nice</div><footer>f</footer>"
    assert html.main_text(page) == "A & B\none two\nthree"
    assert html.main_text(None) == html.main_text("") == html.main_text("<script>x</script>") == ""
    assert html.main_text("<div><p>Long text of some words, and more of it here.</p><p>And a second block of text.</p></div><div class='sidebar'><a>x</a></div>").count("\n") == 1


def brute_components(sets, linked):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if sets[i] and sets[j] and linked(sets[i], sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_duplicates(spark, docs):
    sets = {}
    for i, t in texts(docs).items():
        w = WORD.findall(low(t))
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) > 3 else ({tuple(w)} if w else set())
    want = brute_components(sets, lambda x, y: 5 * len(x & y) >= 4 * len(x | y))
    got = {r.doc_id: r for r in minhash.near_duplicates(docs, minhash.NearConfig(shingle=4)).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.n_shingles == len(sets[i]) and r.kept == (want[i] == i) for i, r in got.items())
    odd = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (1, "a b c")], "doc_id long, text string")
    assert [r.kept for r in minhash.near_duplicates(odd).collect()] == [True] * 3
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_tokens_round_trip(spark, docs, tmp_path):
    public = pytest.importorskip("public_tokenizers")
    import base64

    import tiktoken

    plain = tokens.public_config()
    config = tokens.TokenConfig(plain.vocabulary, plain.pattern, length=64, shard_sequences=10)
    shards = tokens.materialise(docs, config, str(tmp_path / "shards"))
    rows = shards.index.collect()
    assert sorted(r.slot for r in rows) == sorted(r.sequence for r in rows) == list(range(shards.sequences))
    read = list(shards.read())
    place = {r.sequence: read[r.slot][: r.n_tokens] for r in rows}
    flat = np.concatenate([place[k] for k in range(shards.sequences)])
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    decode = tiktoken.Encoding("own", pat_str=plain.pattern, mergeable_ranks=ranks, special_tokens={}).decode
    cuts = np.flatnonzero(flat == config.end)
    got = [decode(flat[a:b].tolist()) for a, b in zip([0, *(cuts + 1)], cuts)]
    assert sorted(got) == sorted(t for t in texts(docs).values() if t)
    assert all((a == b).all() for a, b in zip(shards.read(13), read[13:]))


def test_decontaminate(spark, docs):
    r = random.Random(6)
    items = [" ".join(f"q{r.randrange(300)}" for _ in range(n)) for n in (6, 15, 30, 45)]
    bench = spark.createDataFrame([*enumerate(items), (8, None), (9, "")], "item_id long, text string")
    rows, want = [], set()
    for d in range(40):
        i = d % 4
        t = items[i].split()
        for _ in range(r.randint(0, len(t) // 5)):
            t[r.randrange(len(t))] = f"z{d}"
        rows.append((d, " ".join([f"x{k}" for k in range(20)] + t + ["end"] * 3).title()))
        want.add((d, i))
    rows += [(90, " ".join(f"x{k}" for k in range(80))), (91, None), (92, "")]
    extra = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(1))
    assert {(x.doc_id, x.item_id) for x in decontaminate.leaks(extra, bench).collect()} == want
    assert {x.doc_id for x in decontaminate.clean(extra, bench).collect()} == {90, 91, 92}
    assert decontaminate.leaks(extra, bench.limit(0)).count() == 0


def test_suffixes(spark, docs):
    seen, cover = {}, {}
    for d, t in sorted(texts(docs).items()):
        w = WORD.findall(low(t))
        for k in range(len(w) - 49):
            if (g := tuple(w[k : k + 50])) in seen:
                cover.setdefault(d, set()).update(range(k, k + 50))
            else:
                seen[g] = (d, k)
    got = {}
    for r in suffixes.repeats(docs).collect():
        got.setdefault(r.doc_id, set()).update(range(r.low, r.high))
    assert got == cover and cover
    assert suffixes.repeats(docs.limit(0)).count() == 0
    cut = {r.doc_id: r.text for r in suffixes.remove_repeats(docs).collect()}
    assert all(len(WORD.findall(cut[d])) == len(WORD.findall(texts(docs)[d])) - len(c) for d, c in cover.items())


def brute_repeats(rows):
    seen, cover = set(), {}
    for d, t in sorted(rows):
        w = WORD.findall(low(t))
        for k in range(len(w) - 49):
            if (g := tuple(w[k : k + 50])) in seen:
                cover.setdefault(d, set()).update(range(k, k + 50))
            seen.add(g)
    return cover


def covered(found):
    got = {}
    for r in found.collect():
        got.setdefault(r.doc_id, set()).update(range(r.low, r.high))
    return got


def test_suffixes_around_shared_boilerplate(spark):
    """One passage with varying words on each side: no order of the suffixes has all copies of a repeat side by side."""
    r = random.Random(11)
    passage = [f"p1_{k}" for k in range(48)]
    rows = []
    for d in range(600):
        left, right = [f"l{r.randrange(20)}"], [f"r{r.randrange(20)}"]
        rows.append((d, " ".join([f"x{d}a{k}" for k in range(20)] + left + passage + right + [f"x{d}b{k}" for k in range(20)])))
    want = brute_repeats(rows)
    assert len(want) > 200
    assert covered(suffixes.repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == want


def test_lines(spark, docs):
    got = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert set(range(401, 405)) <= set(got) and 400 not in got
    assert set(range(100, 110)) - set(got) <= {d for d in range(100, 110) if len(texts(docs)[d]) < 48 and len(texts(docs)[d].split()) < 6}
    for d in range(401, 405):
        spans = [texts(docs)[d][s.low : s.high] for s in got[d].removed]
        assert spans == [texts(docs)[400].split("\n")[1]] and spans[0] not in got[d].text
    assert not set(got) & {500, 501, 502, 503}
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_short_lines_go_too(spark):
    rows = [(d, f"Read more\nText number {d} of these\nOK") for d in range(4)] + [(9, "Fine. Fine. It is.")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: f"Text number {d} of these" for d in range(1, 4)}


def test_decontaminate_long_items():
    """Edits of all kinds up to a fifth of the words of long items."""
    r = random.Random(12)
    for n in (100, 200, 400):
        item = [f"q{r.randrange(300)}" for _ in range(n)]
        config = decontaminate.LeakConfig()
        items = decontaminate.prepare([(1, " ".join(item))], config)
        for trial in range(15):
            t = list(item)
            for _ in range(n // 5):
                k = r.randrange(len(t))
                t[k : k + 1] = ([], [t[k], f"z{r.randrange(900)}"], [f"z{r.randrange(900)}"])[r.randrange(3)]
            text = " ".join([f"x{k}" for k in range(30)] + t + ["end"] * 9)
            codes, _ = decontaminate.word_codes(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
            assert len(decontaminate.find(items, codes, config)) == 1, (n, trial)


def test_mixed_documents_without_ids(spark):
    """Rows with null or repeated ids and texts of different length, and equal rows, are documents of their own."""
    rows = [(i if i < 8 else None if i < 14 else 7, " ".join(f"d{i}w{k}" for k in range(3 + 11 * i)), "s0") for i in range(16)]
    rows += [(None, "the same row twice " * 10, "s0")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    config = mixing.MixConfig(block=16, shard_slots=8)
    taken = sorted((r["size"], r.taken) for r in mixing.mix_sources(docs, config).documents.collect() if r.taken)
    count = {}
    for r in mixing.mixed_documents(docs, config).collect():
        for w in r.text.split():
            count[w] = count.get(w, 0) + 1
    assert sum(count.values()) == sum(t for _, t in taken)
    size = lambda i: 3 + 11 * i
    got = {i: sum(n for w, n in count.items() if w.startswith(f"d{i}w")) for i in range(16)}
    assert sorted((size(i), n) for i, n in got.items() if n) == [x for x in taken if x[0] in {size(i) for i in range(16)}]
    assert max(count[w] for w in count if w[0] == "d") <= 2


def test_toxicity():
    r = random.Random(2)
    words = ["".join(r.choice(("the", "on", "er", "in", "st", "al", "ou", "re")) for _ in range(r.randint(1, 4))) for _ in range(600)]
    bad = ["zogrik", "mufwad", "kwibbel"]
    rows = []
    for i in range(500):
        t = [r.choice(words) for _ in range(40)]
        if i % 4 == 0:
            t[r.randrange(40)] = r.choice(bad)
        rows.append((" ".join(t), int(i % 4 == 0)))
    model = toxicity.train([t for t, _ in rows[:400]], [y for _, y in rows[:400]], toxicity.ToxicConfig())
    import pyarrow as pa

    score = lambda xs: model.scores(*V.buffers(pa.array(xs, pa.string())))
    got = score([t for t, _ in rows[400:]]) >= 0.5
    assert np.mean(got == np.array([y for _, y in rows[400:]])) > 0.97
    assert (score(["zog.rik", "ZOGRIK"]) >= 0.5).all() and (score([None, "", "the on", "!!"]) < 0.5).all()
    assert (toxicity.train(["a"], [0], toxicity.ToxicConfig()).scores(*V.buffers(pa.array(["x"]))) < 0.5).all()


def test_toxicity_reaches_changed_words():
    """Words with a letter put in or left out come to the machine."""
    r = random.Random(2)
    words = ["".join(r.choice(("the", "on", "er", "in", "st", "al", "ou", "re")) for _ in range(r.randint(1, 4))) for _ in range(600)]
    bad = ["zogrik", "mufwad", "kwibe", "drazz", "pojum"]
    rows = [(" ".join([*(r.choice(words) for _ in range(40)), *([bad[i // 4 % 5]] if i % 4 == 0 else [])]), int(i % 4 == 0)) for i in range(500)]
    model = toxicity.train([t for t, _ in rows], [y for _, y in rows], toxicity.ToxicConfig())
    import pyarrow as pa

    for word in bad:
        changed = [word[:k] + c + word[k:] for k in range(1, len(word)) for c in "aeqxz"] + [word[:k] + word[k + 1 :] for k in range(len(word))]
        scores = model.scores(*V.buffers(pa.array(changed)))
        assert len(set(scores.round(9))) > 2, word  # the machine tells them apart, none is cut off before it


def test_language(spark):
    r = random.Random(3)
    made = {"aa": ["kli", "por", "ten"], "bb": ["zu", "wax", "qem"], "cc": ["éto", "ñis", "üra"]}
    rows = [(i, " ".join("".join(r.choice(made[k]) for _ in range(3)) for _ in range(30)), k) for i in range(300) for k in [sorted(made)[i % 3]]]
    rows += [(900, None, "aa"), (901, "12 !!", None), (902, "", "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1))
    got = {x.doc_id: x for x in language.language_id(docs).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows[:300]) and {got[i].lang_pred for i in (900, 901, 902)} == {"und"}
    assert all(0 <= x.score <= 1 for x in got.values())
    assert language.language_id(docs.limit(0)).count() == 0


def test_embeddings(spark):
    r = np.random.RandomState(5)
    base = r.normal(size=(12, 16))
    x = np.concatenate([base[k % 12] + r.normal(size=16) * 0.12 for k in range(300)]).reshape(300, 16).astype(np.float32)
    x[50:60] = x[0]
    x[70] = x[1] * 2
    label = (np.arange(300) % 12 // 6).tolist()
    rows = [(i, [float(v) for v in x[i]], label[i]) for i in range(300)]
    rows += [(400, None, 0), (401, [0.0] * 16, 0), (402, [float("nan")] * 16, 0), (403, [1.0, None], 0), (404, rows[0][1], None), (405, [], 0)]
    y = x.astype(np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    s = (y @ y.T >= 0.98) & (np.array(label)[:, None] == np.array(label))
    np.fill_diagonal(s, False)
    comp = np.arange(300)
    while True:
        new = np.array([min(comp[i], comp[s[i]].min(initial=999)) for i in range(300)])
        if (new == comp).all():
            break
        comp = new
    config = embeddings.CosineConfig(tile=32)
    got = {v.vec_id: v for v in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), config).collect()}
    assert s.sum() > 300 and len(got) == 306
    assert all((got[i].n_links, got[i].component_id) == (s[i].sum(), comp[i]) for i in range(300))
    assert all(got[i].n_links == 0 and got[i].kept for i in range(400, 406))
