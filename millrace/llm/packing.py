"""Operator 11: best-fit packing of documents into sequences of bounded length, in bulk-synchronous rounds.

1. A document's ids, with an end id behind them, are one piece; longer documents than a sequence are cut. Pieces are
   written once with their ids; from there on only their lengths move.
2. A round deals pieces without a place and sequences with a gap, sorted by length and gap, over range partitions.
   A sweep from small to large gives each gap the largest free piece that is no longer (its successor among the gaps
   is the tightest one that is left). What a partition cannot match keeps its rank: the gaps before, the pieces
   behind. The driver sees two counts a partition, and matches ranks of pieces with ranks of gaps further on, so the
   round is the sweep of one sorted list, however it was dealt. No two pieces can have the same gap.
3. Gaps shrink by what they took, and the next round begins. Where short pieces hold less than a twentieth of all ids, a round has only
   pieces of which as many fit together as of the longest that is left. Pieces longer than every gap cannot be placed at all; the
   longest of them open as many sequences as their sum needs at least, or their number where no two fit together.
4. When only short pieces are left and most of the room is in gaps that hold many of them, a round lays pieces and gaps end to end, both from large to small,
   and a gap takes all pieces that lie inside it; those across a border wait for the next round.

Lengths are whole numbers up to `length`, so the driver plans a round from at most two counts a length. Rows of one
length, however many, spread over partitions by their key.

Null and empty texts are the end id alone. Rows that repeat an id are packed each; a null doc_id is carried along. An
empty table gives no pieces. Any other column of docs is left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .tables import new_path, small_batches, written


@dataclass(frozen=True)
class PackConfig:
    vocabulary: str  #: path of a file that tokenizers reads, whose pieces of words end in tokens that are marked with suffix
    length: int = 4096
    end: int = 1  #: id behind each document
    suffix: str = "</w>"
    cache: int = 1 << 19  #: parts of words that a task remembers, about


def public_pack_config(name: str = "word_bpe_49k.json") -> PackConfig:
    """A vocabulary that is installed as the module public_tokenizers."""
    import public_tokenizers

    return PackConfig(public_tokenizers.path(name))


#: What this file does not split and lower by itself: all but ASCII, and letters that have one form in NFC and keep their first byte
#: in lower case; and what may begin a special token.
_ODD = re.compile("[^ \t\n\v\f\r!-~À-ÖØ-öø-įı-ľŀ-ŷŹ-ſ]|<\\|")
_SPACE = re.compile("[ \t\n\v\f\r]")


def segments(text: str) -> Iterator[tuple[str, bool]]:
    """A text cut at white space into stretches, and whether a stretch is a word with odd characters. Patterns only look for single characters, so long words take no longer than others."""
    at = 0
    while odd := _ODD.search(text, at):
        low = max(at, *(text.rfind(c, at, odd.start()) + 1 for c in " \t\n\v\f\r"))
        end = _SPACE.search(text, odd.end())
        high = end.start() if end else len(text)
        if low > at:
            yield text[at:low], False
        yield text[low:high], True
        at = high
    if at < len(text):
        yield text[at:], False


_BLANK, _LETTER, _DIGIT, _MARK, _ODDS = range(5)


def _plain_tables() -> tuple[np.ndarray, np.ndarray]:
    """Kinds of single bytes, and of the 2-byte letters U+00C0 to U+017F their second byte in lower case, 0 for an odd one. Letters that change the first byte with their case are odd."""
    kind = np.full(256, _ODDS, np.uint8)
    kind[0x21:0x7F], kind[0x20], kind[0x09:0x0E] = _MARK, _BLANK, _BLANK
    for low, high, what in ((0x30, 0x3A, _DIGIT), (0x41, 0x5B, _LETTER), (0x61, 0x7B, _LETTER), (0x80, 0xC0, _LETTER), (0xC3, 0xC6, _LETTER)):
        kind[low:high] = what
    second = np.zeros((3, 64), np.uint8)
    for code in range(0xC0, 0x180):
        first, last = chr(code).encode()
        lower = chr(code).lower().encode()
        if chr(code).isalpha() and len(lower) == 2 and lower[0] == first:
            second[first - 0xC3, last - 0x80] = lower[1]
    return kind, second


_KIND, _SECOND = _plain_tables()


@dataclass
class Parts:
    """Parts of words of a chunk of texts: lowered bytes, where each part begins and ends, the first part of each text, and which texts are odd."""

    raw: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    odd: np.ndarray


def parts_of(raw: np.ndarray, at: np.ndarray) -> Parts:
    """What the vocabulary's own pre-tokeniser finds in texts without odd characters, in lower case: letters, single digits, marks, and the
    ends of contractions. Texts that are odd have no parts."""
    low = V.LOWER[raw]
    kind = _KIND[raw]
    n = len(raw)
    lead = np.flatnonzero((raw >= 0xC3) & (raw < 0xC6))
    odd = kind == _ODDS
    follows = np.zeros(n + 1, bool)
    follows[lead + 1] = True
    odd |= ((raw >= 0x80) & (raw < 0xC0)) != follows[:n]
    lead = lead[lead + 1 < n]
    lead = lead[(raw[lead + 1] >= 0x80) & (raw[lead + 1] < 0xC0)]
    lower = _SECOND[raw[lead] - 0xC3, raw[lead + 1] - 0x80]
    odd[lead[lower == 0]] = True
    low[lead + 1] = lower
    odd[:-1] |= (raw[:-1] == ord("<")) & (raw[1:] == ord("|"))
    texts = np.zeros(len(at) - 1, bool)
    texts[np.searchsorted(at, np.flatnonzero(odd), "right") - 1] = True
    for k in np.flatnonzero(texts):
        kind[at[k] : at[k + 1]] = _BLANK
    edge = np.ones(n + 1, bool)
    edge[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    edge[at] = True
    for k in np.flatnonzero((low == ord("'")) & edge[:n]).tolist():  # a part of its own, if a text goes on with one of these
        if edge[k + 1] and k + 1 < n and kind[k + 1] == _LETTER and not (at[np.searchsorted(at, k + 1)] == k + 1):
            rest = bytes(low[k + 1 : min(k + 3, at[np.searchsorted(at, k, "right")])])
            size = 1 if rest[:1] in (b"s", b"t", b"m", b"d") else 2 if rest in (b"re", b"ve", b"ll") else 0
            if size:
                edge[k + 1], edge[k + 1 + size] = False, True
    edges = np.flatnonzero(edge)
    begin, end = edges[:-1], edges[1:]
    real = kind[begin] != _BLANK
    begin, end = begin[real], end[real]
    return Parts(low, begin, end, np.searchsorted(begin, at), texts)


class WordIds:
    """Ids of texts, through the ids of their parts, which are encoded once and remembered by a 64-bit hash.

    The vocabulary splits texts at white space and into parts, so a text's ids are those of its parts. Texts with odd
    characters are cut into stretches without them and words with them, which are encoded whole.
    """

    def __init__(self, vocabulary: str, config: PackConfig):
        from tokenizers import Tokenizer

        self.model, self.config = Tokenizer.from_str(vocabulary), config
        self.ends = np.zeros(self.model.get_vocab_size(), bool)
        self.ends[[k for token, k in self.model.get_vocab().items() if token.endswith(config.suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.slot: dict[int, int] = {}
        self.low, self.size, self.pool, self.used = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.uint32), 0

    def whole(self, word: str) -> np.ndarray:
        return np.array(self.model.encode(word, add_special_tokens=False).ids, np.uint32)

    def learn(self, hashes: list[int], parts: list[str]) -> None:
        """Encodes parts in one go; each ends in an id that is marked as an end."""
        ids = np.array(self.model.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(parts):  # a part that is not what the vocabulary takes as one
            some = [self.whole(p) for p in parts]
            ids, ends = np.concatenate(some), np.cumsum([len(x) for x in some])
        n, to = len(self.slot), len(self.slot) + len(parts)
        self.low, self.size, self.pool = (np.concatenate([x, np.zeros(max(len(x), need - len(x)), x.dtype)]) if need > len(x) else x for x, need in ((self.low, to), (self.size, to), (self.pool, self.used + len(ids))))
        self.pool[self.used : self.used + len(ids)] = ids
        self.low[n:to] = self.used + np.append(0, ends[:-1])
        self.size[n:to] = np.diff(ends, prepend=0)
        self.used += len(ids)
        self.slot.update(zip(hashes, range(n, to)))

    def encode(self, raw: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """The ids of each text of a chunk."""
        found = parts_of(raw, at)
        hashes = V.slice_hash(V.prefix_hash(found.raw), found.begin, found.end)
        codes, distinct = pd.factorize(hashes)
        if len(self.slot) > self.config.cache:
            self.forget()
        keys = distinct.tolist()
        known = np.fromiter(map(self.slot.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(known < 0)
        if len(new):
            place = np.zeros(len(keys), np.int64)
            place[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)  # where each comes first
            data = found.raw.tobytes()
            known[new] = np.arange(len(self.slot), len(self.slot) + len(new))
            self.learn([keys[k] for k in new.tolist()], [data[a:b].decode() for a, b in zip(found.begin[place[new]].tolist(), found.end[place[new]].tolist())])
        slots = known[codes]
        size = self.size[slots]
        upto = np.append(0, np.cumsum(size))
        ids = self.pool[np.repeat(self.low[slots] - upto[:-1], size) + np.arange(upto[-1])]
        cuts = upto[found.first]
        out = [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        for k in np.flatnonzero(found.odd).tolist():
            out[k] = self.odd(raw[at[k] : at[k + 1]].tobytes().decode())
        return out

    def odd(self, text: str) -> np.ndarray:
        some = [np.zeros(0, np.uint32)]
        for stretch, odd in segments(text):
            if odd:
                some.append(self.whole(stretch))
            else:
                raw = np.frombuffer(stretch.encode(), np.uint8)
                some += self.encode(raw, np.array([0, len(raw)]))
        return np.concatenate(some)


def _encoder(vocabulary: str, config: PackConfig) -> WordIds:
    import sys
    import types
    import zlib

    # a worker serves many tasks; a module of its own outlives them, this function's globals do not
    held = sys.modules.setdefault("_millrace_words", types.ModuleType("_millrace_words")).__dict__.setdefault("held", {})
    name = (zlib.crc32(vocabulary.encode()), len(vocabulary), config.suffix)
    if name not in held:
        held[name] = WordIds(vocabulary, config)
    return held[name]


def cut_pieces(vocabulary: str, config: PackConfig):
    """Batches of doc_id, text to pieces. A key is the task's number and the piece's place in it."""

    def run(batches):
        encode, key, last, size = _encoder(vocabulary, config), TaskContext.get().partitionId() << 33, np.array([config.end], "<u4").tobytes(), 4 * config.length
        for batch, raw, at in V.chunks(batches):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode.encode(raw, at)):
                ids = ids.astype("<u4").tobytes() + last
                for piece, low in enumerate(range(0, len(ids), size)):
                    rows.append((key, doc_id, piece, low // 4, min(size, len(ids) - low) // 4, ids[low : low + size]))
                    key += 1
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 6, kinds)], names=["key", "doc_id", "piece", "start", "length", "ids"])
        V.trim()

    return run


#: Kinds of rows of a state: a piece without a place, a sequence with a gap, a piece that was placed in this round. LEFT counts what a part could not match.
PIECE, GAP, PLACED, LEFT = 0, 1, 2, 3
STATE = "kind int, id long, value int, bin long, offset int"
_KINDS = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
_NAMES = ["kind", "id", "value", "bin", "offset", "part", "rank"]


def _batch(columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], names=_NAMES[: len(columns)])


def sweep(length: int):
    """Batches sorted by value, pieces before gaps: matches as placed rows with the gap that is left; the rest with its part and rank."""

    def run(batches):
        part = TaskContext.get().partitionId()
        free: list[tuple[int, int]] = []
        gaps = 0
        for batch in batches:
            out: list[list] = [[] for _ in _NAMES]
            add = lambda *row: [c.append(v) for c, v in zip(out, row)]
            for kind, key, value in zip(*(batch.column(c).to_pylist() for c in ("kind", "id", "value"))):
                if kind == PIECE:
                    free.append((key, value))
                elif free:
                    piece, size = free.pop()
                    add(PLACED, piece, size, key, length - value, -1, -1)
                    if value > size:
                        add(GAP, key, value - size, None, None, -1, -1)
                else:
                    add(GAP, key, value, None, None, part, gaps)
                    gaps += 1
            if out[0]:
                yield _batch(out)
        for low in range(0, len(free), 1 << 16):
            some = free[low : low + (1 << 16)]
            n = len(some)
            yield _batch([[PIECE] * n, [k for k, _ in some], [v for _, v in some], [None] * n, [None] * n, [part] * n, list(range(low, low + n))])
        if gaps or free:
            yield _batch([[LEFT], [len(free)], [None], [gaps], [None], [part], [None]])

    return run


def runs_between(counts: dict[int, tuple[int, int]]) -> tuple[list[tuple[int, int, int, int, int]], dict[int, int]]:
    """counts: of each part its left gaps and pieces. Returns runs (part of pieces, lowest rank, highest rank + 1, part of gaps, rank of the gap
    that takes the highest), and how many pieces of each part, from the lowest rank on, stay free."""
    stack: list[list[int]] = []
    runs = []
    for part, (gaps, pieces) in sorted(counts.items()):
        at = 0
        while at < gaps and stack:
            source, high = stack[-1]
            n = min(gaps - at, high)
            runs.append((source, high - n, high, part, at))
            at += n
            stack[-1][1] -= n
            if not stack[-1][1]:
                stack.pop()
        if pieces:
            stack.append([part, pieces])
    return runs, dict(stack)


def _ranged(state: DataFrame, order: list) -> DataFrame:
    return state.repartitionByRange(*order).sortWithinPartitions(*order)


def sweep_round(state: DataFrame, least: int, opened: int, shortest: int, config: PackConfig) -> DataFrame:
    """The state after a sweep: state has pieces, and gaps of which those below least are out of use. opened: how many of the longest pieces
    without a gap open a sequence. Pieces below shortest, and gaps that hold none of the others, wait."""
    spark, length = state.sparkSession, config.length
    order = ["value", "kind", "id"]
    live = state.where((F.col("kind") <= GAP) & (F.col("value") >= shortest)).select(*order)
    waits = state.where((F.col("kind") == PIECE) & (F.col("value") < shortest) | (F.col("kind") == GAP) & (F.col("value") >= least) & (F.col("value") < shortest))
    swept = written(_ranged(live, order).mapInArrow(V.trimmed(sweep(length)), STATE + ", part int, rank long"), "swept")
    counts = {r["part"]: (r["bin"], r["id"]) for r in swept.where(f"kind = {LEFT}").select("part", "bin", "id").collect()}
    runs, free = runs_between(counts)
    opens = {}
    for part in sorted(free, reverse=True):
        opens[part] = min(free[part], opened)
        opened -= opens[part]
    kept = spark.createDataFrame([(p, free.get(p, 0) - opens.get(p, 0), free.get(p, 0)) for p in counts] or [(-1, 0, 0)], "part int, stay long, free long")
    # both have at most two rows for each range partition
    pieces = swept.where(f"kind = {PIECE}").join(F.broadcast(kept), "part")
    gaps = swept.where(f"kind = {GAP} and part >= 0")
    ran = spark.createDataFrame(runs or [(-1, 0, 0, 0, 0)], "part int, low long, high long, to int, first long")
    crossing = pieces.where("rank >= free").join(F.broadcast(ran), "part").where("rank >= low and rank < high")
    crossing = crossing.select(F.col("id").alias("piece"), F.col("value").alias("size"), F.col("to").alias("part"), (F.col("first") + F.col("high") - 1 - F.col("rank")).alias("rank"))
    met = gaps.select("part", "rank", F.col("id").alias("gap"), F.col("value").alias("room")).join(crossing, ["part", "rank"], "left")
    # one pass over what met gives the gap that is left, and the piece if there is one
    rows = F.array(
        F.struct(F.lit(GAP).alias("kind"), F.col("gap").alias("id"), (F.col("room") - F.coalesce("size", F.lit(0))).alias("value"), F.lit(None).cast("long").alias("bin"), F.lit(None).cast("int").alias("offset")),
        F.struct(F.lit(PLACED).alias("kind"), F.col("piece").alias("id"), F.col("size").alias("value"), F.col("gap").alias("bin"), (F.lit(length) - F.col("room")).cast("int").alias("offset")),
    )
    met = met.select(F.inline(rows)).where(f"id is not null and (kind = {PLACED} or value > 0)")
    columns = ["kind", "id", "value", "bin", "offset"]
    fresh = pieces.where("rank >= stay and rank < free")
    fresh = fresh.select(F.lit(PLACED).alias("kind"), "id", "value", F.col("id").alias("bin"), F.lit(0).alias("offset")).union(fresh.where(f"value < {length}").select(F.lit(GAP), "id", F.lit(length) - F.col("value"), F.lit(None).cast("long"), F.lit(None).cast("int")))
    after = swept.where("part < 0").select(*columns).union(pieces.where("rank < stay").select(*columns)).union(met).union(fresh)
    if shortest > least:
        after = after.union(waits.select(*columns))
    return written(after, "packed")


#: Lengths that a group of the end-to-end round covers.
STRETCH = 1 << 16


def lengths_before(batches):
    """Adds, for each kind alone, the sum of the values before a row in its part."""
    part, sums = TaskContext.get().partitionId(), [0, 0]
    for batch in batches:
        kind, value = batch.column("kind").to_numpy(), batch.column("value").to_numpy().astype(np.int64)
        start = np.zeros(len(kind), np.int64)
        for k in (PIECE, GAP):
            own = value[kind == k]
            start[kind == k] = sums[k] + np.cumsum(own) - own
            sums[k] += int(own.sum())
        yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("id"), batch.column("value"), pa.array(np.full(len(kind), part, np.int32)), pa.array(start)], names=["kind", "id", "value", "part", "start"])


def fill_stretch(length: int):
    """One stretch of the line: its gaps, with those that reach into it, and its pieces, with those that lie in gaps that reach out of it."""

    def run(table: pa.Table) -> pa.Table:
        kind, key, value, start, home = (table.column(c).to_numpy() for c in ("kind", "id", "value", "start", "home"))
        order = np.argsort(start, kind="stable")
        kind, key, value, start, home = (x[order] for x in (kind, key, value.astype(np.int64), start, home))
        g, p = kind == GAP, kind == PIECE
        at = np.searchsorted(start[g], start[p], "right") - 1
        ends = np.append(start[g] + value[g], -1)  # the last stands for no gap
        inside = (at >= 0) & (start[p] + value[p] <= ends[at])
        left = p.copy()
        left[p] = ~inside & home[p]
        out = [(PIECE, k, v, None, None) for k, v in zip(key[left].tolist(), value[left].tolist())]
        mine = inside & home[g][np.maximum(at, 0)] if g.any() else inside
        at, ids, sizes = at[mine], key[p][mine], value[p][mine]
        taken = np.bincount(at, sizes, int(g.sum())).astype(np.int64)
        before = np.cumsum(sizes) - sizes
        first = np.zeros(int(g.sum()), np.int64)
        first[at[::-1]] = before[::-1]  # the first piece of each gap
        room, bins = value[g], key[g]
        out += [(PLACED, *row) for row in zip(ids.tolist(), sizes.tolist(), bins[at].tolist(), (length - room[at] + before - first[at]).tolist())]
        rest = home[g] & (room > taken)
        out += [(GAP, k, v, None, None) for k, v in zip(bins[rest].tolist(), (room - taken)[rest].tolist())]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 5, _KINDS)], names=_NAMES[:5])

    return run


def fill_round(state: DataFrame, least: int, roomy: int, config: PackConfig) -> DataFrame:
    """The state after pieces were laid along the gaps of at least roomy, end to end. Each gap takes what lies inside it, without holes."""
    spark = state.sparkSession
    columns = ["kind", "id", "value", "bin", "offset"]
    order = [F.desc("value"), F.asc("kind"), F.asc("id")]
    live = state.where((F.col("kind") == PIECE) | (F.col("kind") == GAP) & (F.col("value") >= roomy)).select("kind", "id", "value")
    laid = written(_ranged(live, order).mapInArrow(V.trimmed(lengths_before), "kind int, id long, value int, part int, start long"), "laid")
    sums: dict[int, int] = {PIECE: 0, GAP: 0}
    begins = []
    for part, kind, total in sorted(laid.groupBy("part", "kind").agg(F.sum("value")).collect()):
        begins.append((part, kind, sums[kind]))
        sums[kind] += total
    begins = spark.createDataFrame(begins, "part int, kind int, begin long")
    line = laid.join(F.broadcast(begins), ["part", "kind"]).select("kind", "id", "value", (F.col("start") + F.col("begin")).alias("start"))
    unit = F.floor(F.col("start") / STRETCH)
    # a gap also goes to the stretch it reaches into, a piece also to the stretch whose last gap may reach it
    other = F.when(F.col("kind") == GAP, F.floor((F.col("start") + F.col("value") - 1) / STRETCH)).otherwise(F.floor(F.greatest(F.col("start") - config.length, F.lit(0)) / STRETCH))
    line = line.withColumn("stretch", F.explode(F.array_distinct(F.array(unit, other)))).withColumn("home", F.col("stretch") == unit)
    filled = line.groupBy("stretch").applyInArrow(fill_stretch(config.length), STATE)
    rest = state.where((F.col("kind") == GAP) & (F.col("value") >= least) & (F.col("value") < roomy)).select(*columns)
    return written(filled.union(rest), "packed")


@dataclass
class Packed:
    pieces: DataFrame  #: key, doc_id, piece, start, length, ids (bytes of unsigned 32-bit numbers, little-endian), ids_crc32
    places: DataFrame  #: key, sequence_id, offset
    rounds: int

    def table(self) -> DataFrame:
        """A row for each piece with its place."""
        return self.pieces.join(self.places, "key")

    def sequences(self) -> DataFrame:
        """A row for each sequence: its ids from the first to the last, and its pieces in order. A group has at most `length` ids."""
        rows = self.table().groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids"))).alias("rows"))
        ids = F.aggregate("rows", F.lit(b""), lambda done, row: F.concat(done, row["ids"]))
        return rows.select("sequence_id", ids.alias("ids"), F.transform("rows", lambda row: row.dropFields("ids")).alias("pieces"))


def place(pieces: DataFrame, config: PackConfig) -> tuple[DataFrame, int]:
    """pieces: key (unique), length (1 to config.length). Returns key, sequence_id, offset of each, and the number of rounds."""
    length, spark = config.length, pieces.sparkSession
    state = pieces.where(F.col("length") < length).select(F.lit(PIECE).alias("kind"), F.col("key").alias("id"), F.col("length").cast("int").alias("value"), F.lit(None).cast("long").alias("bin"), F.lit(None).cast("int").alias("offset"))
    placed = pieces.where(F.col("length") == length).select("key", F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rounds, bands = 0, None
    total = lambda x: sum(v * n for v, n in x.items())
    while True:
        sizes: dict[int, dict[int, int]] = {PIECE: {}, GAP: {}}
        for kind, value, n in state.where(f"kind < {PLACED}").groupBy("kind", "value").count().collect():
            sizes[kind][value] = n
        if not sizes[PIECE]:
            return placed, rounds
        rounds += 1
        if bands is None:  # without short pieces to fill what others leave, the longest must be placed for good before the next
            bands = total({v: n for v, n in sizes[PIECE].items() if 8 * v <= length}) * 20 < total(sizes[PIECE])
        least, most = min(sizes[PIECE]), max(sizes[PIECE])
        gaps = {v: n for v, n in sizes[GAP].items() if v >= least}
        roomy = {v: n for v, n in gaps.items() if v >= 4 * most}
        if roomy and sum(sizes[PIECE].values()) >= 2 * sum(roomy.values()) and 2 * total(roomy) >= min(total(sizes[PIECE]), total(gaps)):
            state = fill_round(state, least, 4 * most, config)
        else:
            shortest = max(least, length // (length // most + 1) + 1) if bands else least  # as many fit together as of the longest
            now = {v: n for v, n in sizes[PIECE].items() if v >= shortest}
            stuck = {v: n for v, n in now.items() if v > max(gaps, default=0)}
            alone = sum(n for v, n in stuck.items() if 2 * v > length)
            opened = max(alone, -(-total(stuck) // length), 0 if bands else -(-(total(now) - total(gaps)) // length))
            state = sweep_round(state, least, opened, shortest, config)
        placed = placed.union(state.where(f"kind = {PLACED}").select("id", "bin", F.col("offset").cast("long")))


def pack(docs: DataFrame, config: PackConfig) -> Packed:
    """docs: doc_id (long), text. One pass over the texts; after it, a round shuffles 16 bytes for each piece that is left and each sequence with a gap."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark = docs.sparkSession
    with open(config.vocabulary, encoding="utf-8") as f:
        vocabulary = f.read()
    path = new_path(spark, "pieces")
    schema = "key long, doc_id long, piece int, start long, length int, ids binary"
    with small_batches(spark):
        docs.mapInArrow(cut_pieces(vocabulary, config), schema).withColumn("ids_crc32", F.crc32("ids")).write.option("compression", "zstd").parquet(path)
    pieces = spark.read.schema(schema + ", ids_crc32 long").parquet(path)
    places, rounds = place(pieces.select("key", "length"), config)
    return Packed(pieces, places, rounds)


def best_fit(docs: DataFrame, config: PackConfig) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(docs, config).table().select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")
