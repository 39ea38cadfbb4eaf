"""Operator 5: benchmark decontamination by edit distance.

Texts and items are compared as sequences of words (letters and digits, A-Z lower-cased). A document holds an item if
a window of it is within `share` of the item's words in edits. Windows are as long as the item.

1. Seeds place the windows. By the q-gram lemma a sequence within e edits of an item of n words shares at least
   n - q + 1 - q * e of its q-grams with it, in order; q is 3, or less for items so short that the lemma needs it. Where
   fewer than that many q-grams of a stretch of item length are also the item's, no window there can be within reach.
   The others give windows, at every start from which the item could be reached.
2. Each window and item is embedded by random walks: a walk reads a symbol, writes it, and moves on or stays by a random
   bit drawn for the step and the symbol. Edit distance becomes Hamming distance between the outputs.
   The longer an item, the further the walks of two sequences drift apart, so items of more than `sampled` words are not
   sampled: all windows that the lemma leaves go to step 4, which loses none.
3. Locality-sensitive hashing samples a few output places. It is repeated until a window within the edit threshold
   shares a sample with its item with at least the target recall, given how likely one place agrees.
4. Windows that share a sample with an item, or all windows of a long item, go to an exact edit distance, free at both ends of the window; a document's
   best window of an item is its row.

Null and empty texts hold nothing; items without words are held by nothing. Repeated rows give repeated results.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import vectors as V

INSIDE = np.zeros(256, bool)
INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


#: Windows that are embedded at once.
WINDOWS = 4096


@dataclass(frozen=True)
class LeakConfig:
    share: float = 0.2  #: edits, as a share of the item's words, that a leak may have
    gram: int = 3
    sample: int = 4  #: output places in a hash
    agree: float = 0.5  #: chance that one output place of a window at the threshold agrees with the item's, for items of up to 20 words
    apart: float = 0.004  #: by how much that chance is less for each word more, as the walks drift apart
    recall: float = 0.999
    sampled: int = 50  #: words of the longest item whose windows are sampled
    walks: int = 4  #: independent walks, each with its own part of the hashes
    item_block: int = 20_000  #: items that are shipped to the executors at once
    seed: int = 55

    def hashes(self, size: int) -> int:
        """So many reach the recall for items of `size` words."""
        agree = self.agree - self.apart * max(0, size - 20)
        return math.ceil(math.log(1 - self.recall) / math.log(1 - agree**self.sample))


@dataclass
class Items:
    ids: np.ndarray
    codes: list  #: words of each item
    edits: np.ndarray
    need: np.ndarray  #: q-grams that a stretch must share
    grams: np.ndarray  #: sorted q-gram hashes of all items
    owner: np.ndarray  #: item of each
    place: np.ndarray  #: and its place in the item
    samples: list  #: for each item its hashes
    sizes: list  #: the q that items use


def word_codes(raw: np.ndarray, at: np.ndarray):
    raw = V.LOWER[raw]
    found = V.words(raw, at, INSIDE[raw])
    return V.slice_hash(V.prefix_hash(raw), found.begin, found.end), found


def walk(codes: np.ndarray, steps: int, key: int) -> np.ndarray:
    """Random-walk embedding of rows of words (0 pads their ends): steps outputs for each row."""
    n, width = codes.shape
    padded = np.concatenate([codes, np.zeros((n, 1), V.U64)], axis=1)
    at, out, rows = np.zeros(n, np.int64), np.empty((n, steps), V.U64), np.arange(n)
    keys = V.mix(np.arange(steps, dtype=V.U64) + V.mix(np.array([key], V.U64)))
    for step in range(steps):
        symbol = padded[rows, np.minimum(at, width)]
        out[:, step] = symbol
        at += (V.mix(symbol ^ keys[step]) >> V.U64(63)).astype(np.int64)
    return out


def samples(codes: np.ndarray, size: int, config: LeakConfig) -> np.ndarray:
    """Of windows for an item of `size` words: a row of hashes each."""
    random, steps, out = np.random.RandomState(config.seed), 3 * size, []
    for w in range(config.walks):
        embedded = walk(codes, steps, config.seed * 1000 + w)
        for _ in range(-(-config.hashes(size) // config.walks)):
            # early places say most: the walks of two sequences drift apart as edits add up
            picked = np.sort(random.randint(0, 2 * size, config.sample))
            value = np.full(len(codes), V.U64(len(out) + 1))
            for k in picked:
                value = V.mix(value * V.BASE + embedded[:, k] + V.U64(int(k)))
            out.append(value)
    return np.stack(out, axis=1)


def prepare(rows: list[tuple[int, str | None]], config: LeakConfig) -> Items:
    ids, codes = [], []
    for item_id, text in rows:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        found, _ = word_codes(raw, np.array([0, len(raw)]))
        if len(found):
            ids.append(item_id)
            codes.append(found)
    edits = np.array([math.floor(config.share * len(c) + 1e-9) for c in codes], np.int64)
    need, grams, owner, place, sizes = [], [], [], [], set()
    for i, (c, e) in enumerate(zip(codes, edits)):
        q = config.gram if len(c) - config.gram + 1 - config.gram * e > 0 else max(1, next((q for q in range(config.gram, 0, -1) if len(c) - q + 1 - q * e > 0), 1))
        sizes.add(q)
        need.append(max(1, len(c) - q + 1 - q * int(e)))
        g = V.gram_hash(c, q) + V.U64(q)
        grams.append(g)
        owner.append(np.full(len(g), i))
        place.append(np.arange(len(g)))
    cat = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
    grams, owner, place = cat(grams, V.U64), cat(owner, np.int64), cat(place, np.int64)
    order = np.argsort(grams, kind="stable")
    return Items(np.array(ids, np.int64), codes, edits, np.array(need, np.int64), grams[order], owner[order], place[order], [samples(c[None, :], len(c), config)[0] if len(c) <= config.sampled else None for c in codes], sorted(sizes))


def edit_distance(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """(edits, begin, end): the least edits between the item and any stretch of the window, and the first such stretch."""
    n = len(window)
    row, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
    for i, word in enumerate(item):
        best = np.minimum(row[:-1] + (window != word), row[1:] + 1)
        from_left = np.where(row[:-1] + (window != word) <= row[1:] + 1, start[:-1], start[1:])
        new, begin = np.empty(n + 1, np.int64), np.empty(n + 1, np.int64)
        new[0], begin[0] = i + 1, 0
        # cheapest way to reach a place by leaving out words of the window: a running least of cost less place
        cost = np.concatenate([[new[0]], best]) - np.arange(n + 1)
        least = np.minimum.accumulate(cost)
        origin = np.maximum.accumulate(np.where(cost == least, np.arange(n + 1), 0))
        new = least + np.arange(n + 1)
        begin = np.concatenate([[0], from_left])[origin]
        row, start = new, begin
    end = int(np.argmin(row))
    return int(row[end]), int(start[end]), end


def find(items: Items, codes: np.ndarray, config: LeakConfig) -> list[tuple[int, int, int, int]]:
    """(item, edits, first word, end word) of the items that a text's words hold: the best window of each."""
    hits: dict[int, list] = {}
    for q in items.sizes:
        if len(codes) < q:
            continue
        g = V.gram_hash(codes, q) + V.U64(q)
        low, high = np.searchsorted(items.grams, g, "left"), np.searchsorted(items.grams, g, "right")
        for p in np.flatnonzero(high > low):
            for k in range(low[p], high[p]):
                hits.setdefault(int(items.owner[k]), []).append(int(p))
    out = []
    for i, places in hits.items():
        n, e = len(items.codes[i]), int(items.edits[i])
        places = np.unique(places)
        # stretches of item length, and its edits, that hold enough of its q-grams
        span = n + e
        count = np.searchsorted(places, places + span, "left") - np.arange(len(places))
        dense = places[count >= items.need[i]]
        if not len(dense):
            continue
        # the first shared q-gram of a window is at most n - need words after its start
        starts = np.unique((dense[:, None] - np.arange(0, n - int(items.need[i]) + 1)[None, :]).reshape(-1))
        starts = starts[(starts >= 0) & (starts < len(codes))]
        begins, found = starts, None
        if n <= config.sampled:
            padded = np.concatenate([codes, np.zeros(n, V.U64)])
            blocks = (starts[low : low + WINDOWS] for low in range(0, len(starts), WINDOWS))
            begins = np.concatenate([b[(samples(padded[b[:, None] + np.arange(n)], n, config) == items.samples[i]).any(axis=1)] for b in blocks])
        # windows that overlap are decided together
        heads = np.flatnonzero(np.concatenate([[True], np.diff(begins) > n + 2 * e])) if len(begins) else []
        for first, last in zip(heads, [*heads[1:], len(begins)]):
            low = max(0, int(begins[first]) - e)
            edits, begin, end = edit_distance(items.codes[i], codes[low : int(begins[last - 1]) + n + e])
            if edits <= e and (found is None or edits < found[1]):
                found = (i, edits, low + begin, low + end)
        if found:
            out.append(found)
    return out


def _held(items: Items, config: LeakConfig):
    """Of a chunk of texts: (text, item, edits, first word, end word) of each item that a text holds, and the words."""
    known = np.unique(items.grams)
    table = np.zeros(1 << 22, bool)
    table[(known >> V.U64(42)).astype(np.int64)] = True

    def run(raw, at):
        codes, found = word_codes(raw, at)
        near = np.zeros(len(codes), bool)
        for q in items.sizes:
            g = V.gram_hash(codes, q) + V.U64(q)
            some = np.flatnonzero(table[(g >> V.U64(42)).astype(np.int64)])
            near[some[np.isin(g[some], known)]] = True
        hits = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(near, out=hits[1:])
        which = np.flatnonzero(hits[found.first[1:]] > hits[found.first[:-1]])
        return [(int(t), *x) for t in which for x in find(items, codes[found.first[t] : found.first[t + 1]], config)], found

    return run


def leak_rows(items: Items, config: LeakConfig):
    held = _held(items, config)

    def run(batches):
        for batch, raw, at in V.chunks(batches):
            hits, found = held(raw, at)
            rows = []
            for t, i, edits, first, end in hits:
                begin, stop = found.begin[found.first[t] + first], found.end[found.first[t] + end - 1]
                chars = lambda b: int(((raw[at[t] : b] & 0xC0) != 0x80).sum())  # noqa: B023, E731
                rows.append((t, int(items.ids[i]), edits, len(items.codes[i]), chars(begin), chars(stop)))
            cols = list(zip(*rows)) if rows else [[]] * 6
            ids = batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(cols[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in cols[1:])], names=["doc_id", "item_id", "edits", "item_words", "low", "high"])

    return run


def clean_rows(items: Items, config: LeakConfig):
    held = _held(items, config)

    def run(batches):
        for batch, raw, at in V.chunks(batches):
            stays = np.ones(batch.num_rows, bool)
            stays[[x[0] for x in held(raw, at)[0]]] = False
            yield batch.filter(pa.array(stays))

    return run


def item_blocks(benchmark: DataFrame, config: LeakConfig):
    """The items, made ready, in blocks of at most config.item_block; one block is on the driver at a time."""
    rows = ((r[0], r[1]) for r in benchmark.where("item_id is not null").select("item_id", "text").orderBy("item_id", "text").toLocalIterator())
    first = True
    while (part := list(itertools.islice(rows, config.item_block))) or first:
        yield prepare(part, config)
        first = False


def leaks(docs: DataFrame, benchmark: DataFrame, config: LeakConfig = LeakConfig()) -> DataFrame:
    """docs: doc_id, text; benchmark: item_id, text. A row for each document and item it holds: doc_id, item_id, edits, item_words, low, high (code points).

    Items are shipped in blocks of bounded size; there is one pass over the texts for each block and no shuffle.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text")
    parts = [rows.mapInArrow(leak_rows(items, config), f"doc_id {kind}, item_id long, edits long, item_words long, low long, high long") for items in item_blocks(benchmark, config)]
    return reduce(DataFrame.union, parts)


def clean(docs: DataFrame, benchmark: DataFrame, config: LeakConfig = LeakConfig()) -> DataFrame:
    """The rows of docs that hold no item, with all their columns; each row is judged by its own text. No shuffle."""
    for items in item_blocks(benchmark, config):
        docs = docs.mapInArrow(clean_rows(items, config), docs.schema)
    return docs
