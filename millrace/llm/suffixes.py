"""Operator 6: substring dedup on sparse suffixes.

A repeated passage is `length` or more words that stand in two places, in one document or two, with A-Z lower-cased.

1. Of all suffixes, those stay that begin at a minimiser: a word whose k-gram hash is the least of some window of
   consecutive k-grams. Windows are so short that every passage of `length` words has a minimiser in its first
   `slack` + 1 words, at the same place in each copy; its first core = length - slack words from there on are then equal.
2. Suffixes whose core stands in one place alone go (a count by hash).
3. A suffix answers for the stretches of `length` words that hold its core and whose first window has its least at the
   suffix; which suffix that is depends on the words of the stretch alone. The words from slack before the core to slack
   after it, its context, hold all these stretches. Of suffixes with equal contexts only the earliest goes on: all
   stretches of the others repeat its stretches. So copies of a text, and the inside of long repeats, end here.
4. The others, at the ends of repeats and first of their context, are extended to the left and right word by word: each
   of their stretches becomes a hash, and stretches are grouped by it. The earliest of a group, by (doc_id, word), stays;
   all others repeat it. A comparison with the neighbour in the order of the sorted suffixes alone would lose repeats
   around shared text, where the partner that shares the words before and after is not the neighbour.
5. Overlapping stretches of a document are joined, so a passage of any length comes out whole.

Where a repeat overlaps the occurrence that stays, in a run of one word or a text that goes in circles, it begins behind
it. Null and empty texts and texts of fewer words have no repeats. Rows with a null id are passed over; repeated rows of
one id are one document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .tables import written

@dataclass(frozen=True)
class RepeatConfig:
    length: int = 50  #: words
    gram: int = 8
    slack: int = 17  #: words before the first minimiser of a passage
    shipped: int = 4_000_000  #: suffixes to extend that are broadcast to their texts, 4 bytes each; more are joined by shuffle

    @property
    def window(self) -> int:
        return self.slack + 1

    @property
    def core(self) -> int:
        return self.length - self.slack


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each run of width values, by its first place."""
    size = 1
    while size * 2 <= width:
        x, size = pick(x[:-size], x[size:]), size * 2
    return pick(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def minimisers(codes: np.ndarray, first: np.ndarray, config: RepeatConfig) -> np.ndarray:
    """Places of the suffixes that stay. first: where each text's words begin, the end last."""
    n = len(codes)
    if n < config.length:
        return np.zeros(0, np.int64)
    grams = V.gram_hash(codes, config.gram)
    least = _sliding(grams, config.window, np.minimum)
    # windows count only inside a text that has a whole passage from their first word on
    text = np.searchsorted(first, np.arange(len(least)), "right") - 1
    least[np.arange(len(least)) + config.window + config.gram - 1 > first[text + 1]] = 0
    padded = np.concatenate([np.zeros(config.window - 1, V.U64), least, np.zeros(config.window - 1, V.U64)])
    most = _sliding(padded, config.window, np.maximum)[: len(grams)]
    places = np.flatnonzero(most == grams[: len(most)])
    ends = first[np.searchsorted(first, places, "right")]
    return places[places + config.core <= ends]


def _codes(raw, at):
    raw = V.LOWER[raw]
    found = V.words(raw, at)
    return V.slice_hash(V.prefix_hash(raw), found.begin, found.end), found.first


def _starts(codes: np.ndarray, first: np.ndarray, places: np.ndarray, text: np.ndarray, config: RepeatConfig) -> np.ndarray:
    """For each suffix and number of words before it: whether it answers for the stretch that begins there."""
    starts = places[:, None] - np.arange(config.slack + 1)
    good = (starts >= first[text][:, None]) & (starts + config.length <= first[text + 1][:, None])
    grams = V.gram_hash(codes, config.gram)
    least = _sliding(grams, config.window, np.minimum) if len(codes) >= config.length else np.zeros(1, V.U64)
    return good & (least[np.clip(starts, 0, len(least) - 1)] == grams[places][:, None])


def suffix_hashes(config: RepeatConfig):
    """Rows core, context, doc_id, place, most, least: of each suffix the hashes of its core and context, and how many words before it the stretches begin for which it answers."""

    def run(batches):
        for batch, raw, at in V.chunks(batches):
            codes, first = _codes(raw, at)
            places = minimisers(codes, first, config)
            text = np.searchsorted(first, places, "right") - 1
            good = _starts(codes, first, places, text, config)
            some = good.any(axis=1)
            places, text, good = places[some], text[some], good[some]
            run = V.code_hash(codes)
            low, high = np.maximum(places - config.slack, first[text]), np.minimum(places + config.length, first[text + 1])
            # where the text cuts the context off is part of it
            context = V.mix(V.slice_hash(run, low, high) + (places - low).astype(V.U64) * V.BASE)
            core = V.slice_hash(run, places, places + config.core)
            most, least = config.slack - good[:, ::-1].argmax(axis=1), good.argmax(axis=1)
            ids = batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(text))
            yield pa.RecordBatch.from_arrays([pa.array(V.signed(core)), pa.array(V.signed(context)), ids, pa.array((places - first[text]).astype(np.int32)), pa.array(most.astype(np.int8)), pa.array(least.astype(np.int8))], names=["core", "context", "doc_id", "place", "most", "least"])

    return run


def passage_rows(config: RepeatConfig):
    """Rows doc_id, text, places: a row for each stretch for which a suffix at one of the places answers, with its hash."""

    def run(batches):
        for batch, raw, at in V.chunks(batches):
            codes, first = _codes(raw, at)
            lists = batch.column(batch.schema.get_field_index("places"))
            text = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            places = lists.flatten().to_numpy().astype(np.int64) + first[text]
            inside = places < first[text + 1]  # rows of one id may have several texts
            places, text = places[inside], text[inside]
            held = np.zeros(len(codes), bool)
            held[(places[:, None] - np.arange(config.slack + 1))[_starts(codes, first, places, text, config)]] = True
            low = np.flatnonzero(held)
            text = np.searchsorted(first, low, "right") - 1
            ids = batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(text))
            yield pa.RecordBatch.from_arrays([pa.array(V.signed(V.slice_hash(V.code_hash(codes), low, low + config.length))), ids, pa.array((low - first[text]).astype(np.int32))], names=["passage", "doc_id", "low"])

    return run


def joined(config: RepeatConfig):
    """Rows doc_id, low, high, first_doc_id, first_low in order: stretches that overlap or touch become one."""

    def rows_of(columns):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=NAMES)

    def run(batches):
        held = None  # the last stretch, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy() for i in range(5)]
            if held is not None:
                rows = [np.concatenate([h, r]) for h, r in zip(held, rows)]
            new = np.concatenate([[True], rows[0][1:] != rows[0][:-1]])
            # how far the stretches of a document have come: places of one document lie above all of those before
            base = (np.cumsum(new) - 1) << 32
            reach = np.maximum.accumulate(base + rows[2])
            heads = np.flatnonzero(np.concatenate([[True], (base + rows[1])[1:] > reach[:-1]]) | new)
            out = [x[heads] for x in rows]
            last = np.concatenate([heads[1:], [len(new)]]) - 1
            out[2] = (reach[last] - base[last]).astype(np.int32)
            yield rows_of([x[:-1] for x in out])
            held = [x[-1:].copy() for x in out]
        if held is not None:
            yield rows_of(held)

    return run


NAMES = ["doc_id", "low", "high", "first_doc_id", "first_low"]


def repeats(docs: DataFrame, config: RepeatConfig = RepeatConfig()) -> DataFrame:
    """docs: doc_id (long), text. A row for each stretch that repeats an earlier one: doc_id, low, high (words), first_doc_id, first_low.

    Shuffles: core hashes to their count (pre-aggregated), suffixes to the cores that repeat, those to the first of their
    context (pre-aggregated), the stretches of those that are left to the first of their hash, and repeats to their
    documents. Texts are shuffled only where the suffixes to extend are more than config.shipped. A passage that a third
    of all documents hold is a few hashes: the tables that repeated hashes are joined with have one row each, so that
    Spark can split the other side where it is skewed.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    hashes = docs.mapInArrow(suffix_hashes(config), "core long, context long, doc_id long, place int, most byte, least byte")
    again = written(hashes.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"), "cores")
    suffixes = written(hashes.join(again, "core").drop("core"), "suffixes")
    first = suffixes.groupBy("context").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count("*").alias("n")).where("n > 1").select("context", "first")
    told = suffixes.join(written(first, "contexts"), "context", "left")
    copy = f"first is not null and (doc_id <> first.doc_id or place - most >= first.place - least + {config.length})"  # without overlap
    told = written(told.select("doc_id", "place", "most", "least", F.when(F.expr(copy), F.col("first")).alias("first")), "told")
    copies = told.where("first is not null").select("doc_id", (F.col("place") - F.col("most")).alias("low"), (F.col("place") - F.col("least") + config.length).alias("high"), F.col("first.doc_id").alias("first_doc_id"), (F.col("first.place") - F.col("most")).alias("first_low"))
    places = written(told.where("first is null").groupBy("doc_id").agg(F.array_sort(F.collect_set("place")).alias("places")), "places")
    if (places.agg(F.sum(F.size("places"))).first()[0] or 0) <= config.shipped:
        places = F.broadcast(places)
    rows = written(docs.join(places, "doc_id").mapInArrow(passage_rows(config), "passage long, doc_id long, low int"), "passages")
    first = rows.groupBy("passage").agg(F.min(F.struct("doc_id", "low")).alias("first"), F.count("*").alias("n")).where("n > 1").select("passage", F.col("first.doc_id").alias("first_doc_id"), F.col("first.low").alias("first_low"))
    later = rows.join(written(first, "firsts"), "passage").where("doc_id <> first_doc_id or low <> first_low")
    skip = F.when(F.col("doc_id") == F.col("first_doc_id"), F.greatest(F.col("first_low") + config.length - F.col("low"), F.lit(0))).otherwise(0)
    later = later.select("doc_id", (F.col("low") + skip).alias("low"), (F.col("low") + config.length).alias("high"), "first_doc_id", (F.col("first_low") + skip).alias("first_low"))
    both = later.union(copies).select("doc_id", *[F.col(c).cast("int" if c in ("low", "high", "first_low") else "long").alias(c) for c in NAMES[1:]])
    return both.repartition("doc_id").sortWithinPartitions(*NAMES).mapInArrow(joined(config), "doc_id long, low int, high int, first_doc_id long, first_low int")


def _cut(batches):
    for batch in batches:
        out = []
        for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            raw = np.frombuffer(text.encode(), np.uint8)
            found = V.words(raw, np.array([0, len(raw)]))
            parts, at = [], 0
            for s in gone:
                parts.append(raw[at : found.begin[s["low"]]].tobytes())
                at = found.end[s["high"] - 1]
            out.append((b"".join(parts) + raw[at:].tobytes()).decode())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), batch.column(2)], names=["doc_id", "text", "removed"])


def remove_repeats(docs: DataFrame, config: RepeatConfig = RepeatConfig()) -> DataFrame:
    """A row for each document with a repeat: doc_id, text without its repeats, removed (their stretches of words)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    by_doc = repeats(docs, config).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("low", "high", "first_doc_id", "first_low"))).alias("removed"))
    return docs.join(by_doc, "doc_id").select("doc_id", "text", "removed").mapInArrow(_cut, "doc_id long, text string, removed array<struct<low:int,high:int,first_doc_id:bigint,first_low:int>>")
