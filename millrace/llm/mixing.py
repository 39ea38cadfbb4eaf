"""Operator 1: mixing sources to target weights.

The words of each source are laid end to end in a fixed order and packed into blocks of a fixed length. Each output
shard draws its source counts from a multinomial over what each source still has to give, so that the last shard
ends every source on its target. Slots of a source run through a keyed permutation of its block numbers, a new one
for each pass, and blocks are joined by number.

Rows with null or empty text have no words and are taken 0 times; a null source is a source of its own, placed last;
repeated rows and ties stay separate rows, in an order that does not depend on the layout of the input.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import vectors as V
from .tables import written

#: Sources are labels of a corpus, so their table is small; up to this many of them it is broadcast, beyond it joined by shuffle.
BROADCAST_SOURCES = 20_000


@dataclass(frozen=True)
class MixConfig:
    weights: tuple[float, ...] = (5, 2, 1)  #: by source in code point order, repeating
    share: float = 1.5  #: words of the mix, as a multiple of all words
    most: float = 2.0  #: no target is above this multiple of its source's words
    block: int = 512  #: words in a block
    shard_slots: int = 4096  #: block slots in an output shard, more where there would be over max_shards
    max_shards: int = 4096
    seed: int = 17


@dataclass
class Mix:
    documents: DataFrame  #: doc_id, size, source_size, target, taken: a row for each input row
    places: DataFrame  #: source_ix, doc_key, doc_id, block, low, high: which words of which block a row's words are
    slots: DataFrame  #: shard, source_ix, slot, pass, block, words: the mix itself
    sources: DataFrame  #: source, source_ix, source_size, target


def word_counts(batches):
    """Of texts: their numbers of words, beside the other columns."""
    for batch, raw, at in V.chunks(batches):
        keep = [c for c in batch.schema.names if c != "text"]
        counts = V.words(raw, at).counts.astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in keep] + [pa.array(counts)], names=[*keep, "size"])


def targets(sizes: list[int], config: MixConfig) -> list[float]:
    """Shares by weight; what is above a source's most goes to the others, again by weight."""
    weights = [config.weights[i % len(config.weights)] for i in range(len(sizes))]
    out, free, left = [0.0] * len(sizes), set(range(len(sizes))), config.share * sum(sizes)
    while free:
        unit = left / sum(weights[i] for i in free)
        over = [i for i in free if unit * weights[i] > config.most * sizes[i]]
        if not over:
            for i in free:
                out[i] = unit * weights[i]
            break
        for i in over:
            out[i] = config.most * sizes[i]
            left -= out[i]
            free.discard(i)
    return out


def draw_plan(sizes: list[int], goals: list[float], config: MixConfig) -> list[tuple]:
    """(source_ix, shard, first slot, slots, blocks, size, goal in words): a multinomial draw for each shard, by what is left of each source."""
    words = [min(round(g), math.floor(config.most * s)) for g, s in zip(goals, sizes)]
    blocks = [-(-s // config.block) for s in sizes]
    # a pass over a source takes all its blocks; what is left after whole passes takes as many slots as could be needed
    slots = [0 if not s else (w // s) * b + min(b, -(-(w % s) // config.block) + bool(w % s)) for w, s, b in zip(words, sizes, blocks)]
    left = np.array(slots, np.int64)
    total = int(left.sum())
    per = max(config.shard_slots, -(-total // config.max_shards))
    random, given, plan, shard = np.random.RandomState(config.seed), np.zeros(len(slots), np.int64), [], 0
    while left.sum() > 0:
        ask = int(min(per, left.sum()))
        got = np.zeros_like(left)
        while (missing := ask - int(got.sum())) > 0:
            rest = left - got
            got += np.minimum(random.multinomial(missing, rest / rest.sum()), rest)
        plan += [(i, shard, int(given[i]), int(got[i]), blocks[i], sizes[i], words[i]) for i in range(len(slots)) if got[i]]
        given, left, shard = given + got, left - got, shard + 1
    return plan


def slot_blocks(config: MixConfig):
    """Which block each slot takes, and how many of its words: the last words of a source's target end inside a block."""

    def run(batches):
        for batch in batches:
            ix, shard, slot, blocks, size, goal = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("source_ix", "shard", "slot", "blocks", "size", "goal"))
            turn = slot // blocks
            key = V.mix((ix.astype(V.U64) << V.U64(32)) ^ turn.astype(V.U64) ^ V.mix(np.full(len(ix), config.seed, V.U64)))
            block = V.feistel(slot % blocks, blocks, key)
            lack = blocks * config.block - size
            # words taken before this slot in its pass: whole blocks, less what the short block lacks if it came before
            before = (slot % blocks) * config.block - np.where(_place_of_last(blocks, key) < slot % blocks, lack, 0)
            have = np.where(block == blocks - 1, config.block - lack, config.block)
            words = np.clip(goal - turn * size - before, 0, have)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (shard, ix, slot, turn, block, words.astype(np.int64))], names=["shard", "source_ix", "slot", "pass", "block", "words"])

    return run


def _place_of_last(blocks: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For each row: which index the permutation sends to the last block; computed once for each source and pass."""
    pairs, back = np.unique(np.stack([blocks.astype(V.U64), key]), axis=1, return_inverse=True)
    return V.unfeistel((pairs[0] - V.U64(1)).astype(np.int64), pairs[0], pairs[1])[back.reshape(-1)]


def mix_sources(docs: DataFrame, config: MixConfig = MixConfig(), row: str | None = None) -> Mix:
    """docs: doc_id, source, text; other columns are ignored, but `row`, which orders ties and is carried to the places.

    Shuffles: counts by source and bucket (pre-aggregated), one by (source, bucket) of a row for each document without
    its text, one by (source, block). No group is larger than a bucket or a block, however large a source is.
    """
    spark = docs.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    more = [row] if row else []
    kept = ["doc_id", "source", *more]
    sized = written(docs.select(*kept, "text").mapInArrow(word_counts, ", ".join(f"{c} {kinds[c]}" for c in kept) + ", size long"), "sizes")
    found = [tuple(r) for r in sized.groupBy("source").agg(F.sum("size"), F.count("*")).collect()]
    found.sort(key=lambda r: (r[0] is None, r[0]))  # Python compares by code point
    sizes, rows = [int(r[1]) for r in found], sum(r[2] for r in found)
    goals = targets(sizes, config)
    sources = spark.createDataFrame([(r[0], i, s, float(g)) for i, (r, s, g) in enumerate(zip(found, sizes, goals))], f"source {kinds['source']}, source_ix int, source_size long, target double")
    small = F.broadcast(sources) if len(found) <= BROADCAST_SOURCES else sources
    buckets = max(1, min(1 << 20, -(-rows // 512)))
    d = sized.join(small, sized["source"].eqNullSafe(small["source"]), "left").drop("source")
    d = d.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), F.lit(buckets)).cast("int"))
    base = d.groupBy("source_ix", "bucket").agg(F.sum("size").alias("n"))
    base = base.select("source_ix", "bucket", (F.sum("n").over(Window.partitionBy("source_ix").orderBy("bucket")) - F.col("n")).alias("base"))
    order = Window.partitionBy("source_ix", "bucket").orderBy("doc_id", "size", *more)
    d = d.withColumn("nth", F.row_number().over(order)).withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.join(base, ["source_ix", "bucket"]).withColumn("start", F.col("base") + F.col("upto") - F.col("size"))
    d = written(d.select("source_ix", F.struct("bucket", "nth").alias("doc_key"), "doc_id", *more, "size", "source_size", "target", "start"), "placed")
    size, length = F.lit(config.block), F.col("start") + F.col("size")
    places = d.where("size > 0").select("source_ix", "doc_key", "doc_id", *more, "size", "start", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((length - 1) / size))).alias("block"))
    places = places.select("source_ix", "doc_key", "doc_id", *more, "start", "block", F.greatest(F.col("start") - F.col("block") * size, F.lit(0)).alias("low"), F.least(length - F.col("block") * size, size).alias("high"))
    plan = spark.createDataFrame(draw_plan(sizes, goals, config), "source_ix int, shard int, first long, n long, blocks long, size long, goal long")
    slots = plan.select("source_ix", "shard", "blocks", "size", "goal", F.explode(F.expr("sequence(first, first + n - 1)")).alias("slot"))
    slots = slots.mapInArrow(V.trimmed(slot_blocks(config)), "shard int, source_ix int, slot long, pass long, block long, words long").where("words > 0")
    slots = written(slots, "slots")
    by_block = slots.groupBy("source_ix", "block").agg(F.collect_list("words").alias("takes"))
    took = places.join(by_block, ["source_ix", "block"])
    took = took.groupBy("source_ix", "doc_key").agg(F.sum(F.expr("aggregate(takes, 0L, (n, w) -> n + least(high, w) - least(low, w))")).alias("taken"))
    out = d.join(took, ["source_ix", "doc_key"], "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source_ix", "doc_key")
    return Mix(out, places, slots, sources)


def _taken(batches):
    """Texts cut to their stretches of words, which are the last column; a text that is taken whole stays as it is."""
    for batch, raw, at in V.chunks(batches):
        found, out = V.words(raw, at), []
        for i, spans in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
            parts, end, zero = [], 0, int(found.first[i])
            for low, high in sorted((s["low"], s["high"]) for s in spans):
                if parts and low <= end:
                    parts[-1] = (parts[-1][0], high)
                else:
                    parts.append((low, high))
                end = high
            whole = parts == [(0, int(found.counts[i]))]
            out.append(raw[at[i] : at[i + 1]].tobytes() if whole else b"\n".join(raw[found.begin[zero + low] : found.end[zero + high - 1]].tobytes() for low, high in parts))
        texts, names = pa.array(out, pa.binary()).cast(pa.string()), batch.schema.names[:-1]
        columns = dict(zip(names, batch.columns))
        columns["text"] = texts
        if "n_chars" in columns:
            columns["n_chars"] = pc.utf8_length(texts).cast(columns["n_chars"].type)
        yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)


def mixed_documents(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """The mix as documents, with the columns of docs: a row for each document and pass, its text cut to the words taken.

    n_chars, where there is such a column, is counted anew. Each row of docs is a document of its own, also where ids are
    null or repeat: texts are found by a digest of all columns, and rows that are equal in all of them have one text.
    Documents without words, and passes that take nothing, give no row.
    """
    # a hash passes over nulls, so which columns are null is hashed too; two seeds make a collision as good as impossible
    values = [x for c in docs.columns for x in (F.col(c), F.col(c).isNull())]
    keyed = docs.where("text is not null").withColumn("_mix_row", F.concat_ws(" ", F.xxhash64(*values), F.xxhash64(F.lit(config.seed), *values)))
    mix = mix_sources(keyed, config, "_mix_row")
    taken = mix.places.join(mix.slots.select("source_ix", "block", "pass", "words"), ["source_ix", "block"]).where("words > low")
    spans = taken.select("source_ix", "doc_key", "_mix_row", "pass", F.struct((F.col("block") * config.block + F.col("low") - F.col("start")).alias("low"), (F.col("block") * config.block + F.least("high", "words") - F.col("start")).alias("high")).alias("span"))
    spans = spans.groupBy("source_ix", "doc_key", "_mix_row", "pass").agg(F.collect_list("span").alias("_mix_spans")).select("_mix_row", "_mix_spans")
    both = keyed.dropDuplicates(["_mix_row"]).join(spans, "_mix_row").select(*docs.columns, "_mix_spans")
    return both.mapInArrow(_taken, docs.schema)
