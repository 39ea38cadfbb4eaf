"""What each operator promises, against brute force: hot groups, nulls, repeats, ties, empty tables, clashing columns, long texts."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import decontaminate, embeddings, html, language, lines, minhash, mixing, queries, suffixes, tokens, toxicity
from millrace.llm import vectors as V

from .test_operators import WORD, brute_components, low


def words_of(text):
    return WORD.findall(low(text))


def shingles(text, n):
    w = words_of(text)
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def frame(spark, rows):
    """doc_id, text, source, and columns whose names clash with those that operators make."""
    full = [(d, t, s, "x", 1, 2.0) for d, t, s in rows]
    return spark.createDataFrame(full, "doc_id long, text string, source string, mark string, n_shingles int, low double").repartition(3)


def test_closures_are_small():
    items = decontaminate.prepare([(1, "a b c d e f g h")], decontaminate.LeakConfig())
    made = {
        "slots": mixing.slot_blocks(mixing.MixConfig()),
        "sketches": minhash.sketches(minhash.NearConfig()),
        "suffixes": suffixes.suffix_hashes(suffixes.RepeatConfig()),
        "units": lines.unit_rows(lines.LineConfig()),
        "leaks": decontaminate.leak_rows(items, decontaminate.LeakConfig()),
    }
    assert len(V._cache["up"])  # the tables are there
    sizes = {k: len(cloudpickle.dumps(f)) for k, f in made.items()}
    assert all(n < (5 << 20 if k == "leaks" else 1 << 19) for k, n in sizes.items()), sizes


def test_mix_weights_and_caps(spark):
    r = random.Random(1)
    rows = [(i, " ".join("w" for _ in range(r.randint(0, 90))), s) for i, s in enumerate(["a"] * 300 + ["b"] * 40 + ["c"] * 300 + [None] * 100)]
    rows += [(None, "one two three", "a"), (None, "one two", "a"), (5, rows[5][1], "a"), (700, None, "b"), (701, "", None)]
    docs = frame(spark, rows)
    got = mixing.mix_sources(docs, mixing.MixConfig(block=16, shard_slots=8)).documents.collect()
    sizes = {s: sum(len(words_of(t)) for _, t, x in rows if x == s) for s in ("a", "b", "c", None)}
    weights, want, free, left = {"a": 5, "b": 2, "c": 1, None: 5}, {}, {"a", "b", "c", None}, 1.5 * sum(sizes.values())
    while free:
        over = [s for s in free if left * weights[s] / sum(weights[x] for x in free) > 2 * sizes[s]]
        for s in over or list(free):
            want[s] = 2 * sizes[s] if over else left * weights[s] / sum(weights[x] for x in free)
        if not over:
            break
        left -= sum(want[s] for s in over)
        free -= set(over)
    assert len(got) == len(rows)
    found = {x.source_size: (x.target, sum(y.taken for y in got if y.source_size == x.source_size)) for x in got}
    for s in sizes:
        target, taken = found[sizes[s]]
        assert target == pytest.approx(want[s]) and abs(taken - target) <= 1
    assert all(0 <= x.taken <= 2 * x["size"] for x in got)


def test_html_keeps_articles():
    words = " ".join(f"word{k}" for k in range(80))
    for kind in ("content-with-sidebar", "post alert-box", "entry social-history"):
        assert html.main_text(f"<body><nav>menu</nav><div class='{kind}'><p>{words}</p></div></body>") == words
    assert html.main_text(f"<article><p>{words}</p><p class='notice-of-death'>He died.</p><math>x=1</math></article>") == f"{words}\nHe died.\nx=1"
    assert html.main_text(f"<article><p>{words} &am<b>p;</b> &lt;</p><div class='comments'><p>{words} {words}</p></div></article>") == f"{words} &amp; <"
    assert html.main_text("<div>" * 20_000 + words) == words


def test_html_density_by_brute_force():
    """The region has the greatest sum of child densities, worked out anew from the tree."""
    import math

    page = "<body><div id=a><p>" + "few words " * 4 + "</p></div><div id=b><div><p>" + "long text of many words " * 12 + "</p><p>" + "more long text " * 9 + "</p></div></div><ul><li><a href=x>link one</a><li><a>link two</a></ul></body>"
    root = html.parse(page)
    html.settle(root)
    nodes = html.measure(root)

    def count(node):
        chars = sum(len(" ".join(x.split())) for x in node.items if isinstance(x, str))
        tags = links = link_tags = 0
        for x in node.items:
            if isinstance(x, html.Node):
                c, t, lc, lt = count(x)
                chars, tags, links, link_tags = chars + c, tags + t + 1, links + lc, link_tags + lt
        return (chars, tags, chars, link_tags + 1) if node.name == "a" else (chars, tags, links, link_tags)

    body = count(next(n for n in nodes if n.name == "body"))
    for n in nodes:
        c, t, lc, lt = count(n)
        if c:
            base = math.log(c / max(1, c - lc) * lc + body[2] / max(1, body[0]) * c + math.e)
            assert n.density == pytest.approx(c / max(1, t) * max(0, math.log(max(1, c * max(1, t) / (max(1, lc) * max(1, lt))))) / base)
    best = max(nodes, key=lambda n: (n.score, n.chars))
    assert " ".join(" ".join(x for x in p.items if isinstance(x, str)) for p in best.items).split() == (("long text of many words " * 12) + ("more long text " * 9)).split()
    assert "long text of many words" in html.main_text(page)


def test_html_table(spark):
    rows = [(1, None, "<p>a b</p>", "x"), (1, "u", "<p>a b</p>", "y"), (2, "v", None, "z"), (None, None, "", None), (3, "w", "<p>" + "lang " * 50_000 + "</p>", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in html.extract(pages).collect()), key=str)
    assert got == sorted([(1, None, "a b", 3), (1, "u", "a b", 3), (2, "v", "", 0), (None, None, "", 0), (3, "w", ("lang " * 50_000).strip(), 249_999)], key=str)
    assert html.extract(pages.limit(0)).count() == 0


def test_near_groups_and_chains(spark):
    """One group of 700 near copies of which some are too far from it, chains whose ends are unlike, null and repeated ids."""
    r = random.Random(3)
    base = [f"b{k}" for k in range(60)]
    rows = []
    for d in range(700):
        w = list(base)
        for _ in range(r.choice((0, 1, 1, 1, 2, 3, 5))):
            w[r.randrange(60)] = f"n{r.randrange(4000)}"
        rows.append((d, " ".join(w), "s"))
    for chain in range(6):
        w = [f"c{chain}_{k}" for k in range(80)]
        for step in range(12):
            rows.append((1000 + chain * 20 + step, " ".join(w), "s"))
            w = w[3:] + [f"c{chain}_{step}_{k}" for k in range(3)]
    rows += [(2000, rows[0][1], "s"), (2000, "other words of the same id " * 9, "s"), (None, rows[0][1], "s"), (3000, None, "s"), (3001, " ", "s")]
    got = minhash.near_duplicates(frame(spark, rows), minhash.NearConfig(shingle=4)).collect()
    assert len(got) == len(rows) and sum(x.doc_id is None for x in got) == 1
    sets = {(d, k): shingles(t, 4) for k, (d, t, _) in enumerate(rows) if d is not None}
    want = brute_components(sets, lambda a, b: 100 * len(a & b) >= 80 * len(a | b))
    expected = sorted((d, len(s), want[d, k][0]) for (d, k), s in sets.items())
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got if x.doc_id is not None) == expected
    left = [x.doc_id for x in minhash.deduplicated(frame(spark, rows), minhash.NearConfig(shingle=4)).collect()]
    assert sorted(x for x in left if x is not None) == sorted({(want[k][0] if sets[k] else k[0], want[k][1]) for k in sets} and [k[0] for k in sets if want[k] == k])
    assert left.count(None) == 1


def test_token_edges(spark, tmp_path):
    config = tokens.public_config()
    rows = [(None, "a b c", "s"), (1, "a b c", "s"), (1, "a b c", "s"), (2, None, "s"), (3, "", "s"), (4, "long " * 30_000, "s")]
    shards = tokens.materialise(frame(spark, rows), config, str(tmp_path / "shards"))
    index = shards.index.collect()
    flat = [int(x) for s in shards.read() for x in s]
    assert sum(x.n_tokens for x in index) == sum(1 for x in flat if x != config.end) + 4
    assert sorted(x.slot for x in index) == list(range(len(index))) and {d for x in index for d in x.doc_ids} == {None, 1, 4}
    assert tokens.materialise(frame(spark, rows).limit(0), config, str(tmp_path / "none")).index.count() == 0


def edited(words, edits, r):
    w = list(words)
    for _ in range(edits):
        k = r.randrange(len(w))
        kind = r.randrange(3)
        if kind == 0:
            w[k] = f"z{r.randrange(10**6)}"
        elif kind == 1:
            w.insert(k, f"z{r.randrange(10**6)}")
        else:
            del w[k]
    return w


@pytest.mark.parametrize("size, trials", [(10, 60), (30, 60), (50, 60), (80, 20), (120, 20), (200, 15), (300, 10)])
def test_leaks_of_every_length(size, trials):
    """Insertions, deletions and substitutions up to the threshold: 0.99 of them at least are found."""
    r, found = random.Random(size), 0
    config = decontaminate.LeakConfig()
    for k in range(trials):
        item = [f"i{r.randrange(3000)}" for _ in range(size)]
        text = [f"t{r.randrange(3000)}" for _ in range(60)] + edited(item, int(0.2 * size), r) + [f"t{r.randrange(3000)}" for _ in range(60)]
        items = decontaminate.prepare([(k, " ".join(item))], config)
        raw = np.frombuffer(" ".join(text).encode(), np.uint8)
        codes, _ = decontaminate.word_codes(raw, np.array([0, len(raw)]))
        found += bool(decontaminate.find(items, codes, config))
    assert found >= 0.99 * trials


def test_leaks_by_brute_force(spark):
    r = random.Random(5)
    some = lambda n: [f"v{r.randrange(60)}" for _ in range(n)]
    items = [(k, " ".join(some(r.randint(8, 25)))) for k in range(12)]
    rows = [(d, " ".join(some(40) + (edited(items[d % 12][1].split(), r.randint(0, 7), r) if d % 3 else []) + some(20)), "s") for d in range(60)]
    rows += [(0, rows[0][1], "s"), (None, items[3][1], "s"), (90, None, "s"), (91, "", "s"), (92, "word " * 60_000 + items[2][1], "s")]

    def least(item, text):  # edits between the item and any stretch of the text
        row = [0] * (len(text) + 1)
        for i, a in enumerate(item):
            new = [i + 1]
            for j, b in enumerate(text):
                new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
            row = new
        return min(row)

    docs, bench = frame(spark, rows), spark.createDataFrame([*items, (None, "v1 v2 v3"), (99, None)], "item_id long, text string")
    want = {(d, k) for d, t, _ in rows if t and len(t) < 9000 for k, x in items if least(x.split(), t.split()) <= int(0.2 * len(x.split()) + 1e-9)} | {(92, 2)}
    got = decontaminate.leaks(docs, bench).collect()
    assert {(x.doc_id, x.item_id) for x in got} == want and len([x for x in got if x.doc_id == 0]) % 2 == 0
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((x.doc_id for x in kept.collect()), key=str) == sorted((d for d, _, _ in rows if not any(d == w[0] for w in want)), key=str)
    assert decontaminate.leaks(docs.limit(0), bench).count() == decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_repeats_in_circles_and_without_ids(spark):
    r = random.Random(6)
    some = lambda n: [f"u{r.randrange(900)}" for _ in range(n)]
    shared = some(70)
    rows = [(1, " ".join(some(20) + ["ha"] * 200 + some(9))), (2, " ".join(["ha"] * 90)), (3, " ".join(["a", "b", "c"] * 60)), (4, " ".join(some(30) + shared)), (5, " ".join(shared + some(30))), (6, " ".join(shared + some(30)).upper()), (None, " ".join(shared)), (7, None), (8, "")]
    seen, want = {}, {}
    for d, t in sorted(x for x in rows if x[0] is not None):
        w = words_of(t)
        for k in range(len(w) - 49):
            g = tuple(w[k : k + 50])
            if g in seen:
                f, at = seen[g]
                want.setdefault(d, set()).update(range(max(k, at + 50) if f == d else k, k + 50))
            else:
                seen[g] = (d, k)
    got = {}
    for x in suffixes.repeats(frame(spark, [(*x, "s") for x in rows])).collect():
        got.setdefault(x.doc_id, set()).update(range(x.low, x.high))
        assert (x.first_doc_id, x.first_low) < (x.doc_id, x.low)
    assert got == want and {1, 2, 3, 5, 6} == set(want)


def test_lines_by_brute_force(spark):
    import re

    r = random.Random(7)
    pool = [f"Line {k} with some more words in it, here. And a sentence of seven words number {k}." for k in range(30)] + ["Read more", "", "OK", "  "]
    rows = [(d, "\n".join(r.choice(pool) if r.random() < 0.5 else f"own {d} {k} text" for k in range(r.randint(1, 9))), "s") for d in range(80)]
    rows += [(None, pool[0], "s"), (200, None, "s"), (201, "", "s"), (202, "x\n\n\ny", "s"), (202, "other\n" + pool[1], "s")]
    units = []
    for n, (d, t, _) in enumerate(rows):
        if d is None or not t:
            continue
        at = 0
        for line in t.split("\n"):
            parts = [(m.start(), m.end()) for m in re.finditer(r"\S.*?(?:[.!?](?=\s|$)|$)", line) if line.strip()]
            whole = (len(line) - len(line.lstrip()), len(line.rstrip()))
            for a, b in {whole, *(p for p in parts if len(line[p[0] : p[1]].split()) >= 6 or len(line[p[0] : p[1]].rstrip().encode()) >= 48)} if line.strip() else ():
                units.append((" ".join(words_of(line[a:b])), d, at + a, at + len(line[:b].rstrip()), n))
            at += len(line) + 1
    first = {}
    for u, d, a, _, _ in units:
        first[u] = min(first.get(u, (d, a)), (d, a))
    want = {}
    for u, d, a, b, n in units:
        if (d, a) != first[u]:
            want.setdefault(n, set()).add((a, b))
    got = lines.dedup_lines(frame(spark, rows)).collect()
    assert sorted((x.doc_id, sorted((s.low, s.high) for s in x.removed)) for x in got) == sorted((rows[n][0], sorted(s)) for n, s in want.items())
    for x in got:
        t = next(t for n, (d, t, _) in enumerate(rows) if n in want and d == x.doc_id and sorted(want[n]) == sorted((s.low, s.high) for s in x.removed))
        keep, gone = [], np.zeros(len(t), bool)
        for s in x.removed:
            gone[s.low : s.high] = True
        at = 0
        for line in t.split("\n"):
            rest = "".join(c for c, g in zip(line, gone[at : at + len(line)]) if not g)
            if rest.strip() or not gone[at : at + len(line)].any():
                keep.append(rest)
            at += len(line) + 1
        assert x.text == "\n".join(keep)


def test_toxic_and_language_tables(spark):
    r = random.Random(9)
    made = {"aa": ["kli", "por", "ten", "va"], "bb": ["zu", "wax", "qem", "ol"]}
    word = lambda k: "".join(r.choice(made[k]) for _ in range(r.randint(2, 4)))
    rows, told = [], []
    for d in range(600):
        k, bad = ("aa", "bb")[d % 2], d % 5 == 2
        w = [word(k) for _ in range(25)]
        if bad:
            w[r.randrange(25)] = r.choice(["gruzzak", "blortem", "smivvok"])
        rows.append((d, " ".join(w), k))
        told.append((d, int(bad)))
    told += [(2, 0), (None, 1), (3, None)]  # labels that disagree, without an id, without a label
    rows += [(900, None, "aa"), (901, "", None), (902, "12 !!", "aa"), (None, rows[0][1], "aa"), (7, rows[7][1], rows[7][2]), (903, "kli" * 40_000, "aa")]
    docs = spark.createDataFrame([(*x, 0.5, True) for x in rows], "doc_id long, text string, lang string, score double, held_out boolean")
    labels = spark.createDataFrame(told, "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows)
    for x in got:
        assert x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 5 == 0)
        assert 0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5)
        if x.held_out and x.doc_id < 600:
            assert x.predicted == int(x.doc_id % 5 == 2), x
    assert all(x.predicted == 0 for x in toxicity.toxicity(docs, labels.limit(0)).collect())
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    for x in language.language_id(docs).collect():
        assert x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 5 == 0)
        want = "und" if x.doc_id in (900, 901, 902) else "aa" if x.doc_id in (None, 903) else ("aa", "bb")[x.doc_id % 2]
        assert x.lang_pred == want and 0 <= x.score <= 1
    assert language.language_id(docs.limit(0)).count() == 0


def test_vectors_of_all_kinds(spark):
    r = np.random.RandomState(2)
    base = r.randn(8, 12)
    rows = [(k, (base[k % 8] + r.randn(12) * r.choice([0.02, 0.2])).tolist(), ("p", "q")[k % 2]) for k in range(160)]
    rows += [(200, [1e200, 2e200] + [0.0] * 10, "p"), (201, [1e-200, 2e-200] + [0.0] * 10, "p"), (202, [0.0] * 12, "p"), (203, None, "p"), (204, [1.0, None] + [0.0] * 10, "p"), (205, [float("nan")] * 12, "p"), (206, base[0].tolist(), None), (None, base[0].tolist(), "p"), (207, rows[0][1], "p"), (207, rows[0][1], "p"), (208, [1.0, 2.0], "p")]
    table = spark.createDataFrame([(*x, 1.0, 9) for x in rows], "vec_id long, embedding array<double>, label string, n double, tile int")
    got = embeddings.near_vectors(table).collect()
    assert len(got) == len(rows)
    sound = {d: (np.array(v) / np.abs(v).max(), lab) for d, v, lab in rows if d is not None and v is not None and lab is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    cos = lambda a, b: a @ b / np.sqrt((a @ a) * (b @ b)) if len(a) == len(b) else -1
    links = {i: {j for j in sound if j != i and sound[i][1] == sound[j][1] and cos(sound[i][0], sound[j][0]) >= 0.98} for i in sound}
    want = brute_components({i: {i} for i in sound}, lambda a, b: min(a) in links[min(b)])
    for x in got:
        if x.vec_id in sound:
            assert (x.n_links, x.component_id, x.kept) == (len(links[x.vec_id]), want[x.vec_id], want[x.vec_id] == x.vec_id), x
        else:
            assert x.n_links == 0 and x.kept
    assert 201 in links[200]
    assert embeddings.near_vectors(table.limit(0)).count() == 0


def test_pipeline_edges(spark, tmp_path):
    """Null and repeated ids, clashing columns, empty texts, and an empty table."""
    r = random.Random(10)
    made = {"aa": ["kli", "por", "ten", "va"], "bb": ["zu", "wax", "qem", "ol"]}
    text = lambda k, n: " ".join("".join(r.choice(made[k]) for _ in range(r.randint(2, 5))) for _ in range(n))
    rows = [(i, text(k, 50), k, f"s{i % 3}") for i in range(80) for k in [("aa", "bb")[i % 2]]]
    rows += [(None, text("aa", 40), "aa", "s0"), (None, text("aa", 30), "aa", None), (3, rows[3][1], "bb", "s0"), (3, text("bb", 44), "bb", "s0"), (90, "", "aa", "s0"), (91, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, mark string, pass int, node long"
    docs = spark.createDataFrame([(*x, len(x[1] or ""), 1, "m", 2, 3) for x in rows], schema)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, text("bb", 15))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = docs
    for (name, stage), left in zip(corpus_pipeline.STAGES[:-1], (84, 83, 83, None)):
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns, name
        found = now.collect()
        assert left is None or len(found) == left, name
        now = spark.createDataFrame(found, schema)
    words = sum(len(words_of(x.text)) for x in found)
    assert abs(words - 1.5 * sum(len(words_of(t)) for _, t, _, _ in rows if t)) < 200
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    docs.limit(0).write.parquet(str(tmp_path / "none/documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "none/benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_queries_are_ten():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 11))
