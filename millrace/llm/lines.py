"""Operator 10: substring dedup by hashing lines, and the sentences of lines.

A unit is a line, or a sentence of a line of several. A unit's digest is 128 bits over its words, with A-Z lower-cased
and white space between words as one space. Every line with a word is a candidate. Sentences are the smaller unit
because shared passages often begin and end inside lines; they are candidates from the least size on, and
LineConfig.sentences leaves them out. Digests are grouped over all documents; the occurrence with the smallest
(doc_id, offset) is kept, all others are removed, and each removal keeps its offsets in the original text and where the
kept occurrence is. Nothing else is removed, but for lines that a removal leaves without text, which go with their line feeds.

Null and empty texts have no units. Rows with a null id have no rank and are passed over. Rows that repeat an id rank
alike, and of each only its own units are cut. Offsets count code points.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .tables import written

_SECOND = V.U64(0xC2B2AE3D27D4EB4F | 1)
_SECOND_INVERSE = V.U64(pow(int(_SECOND), -1, 1 << 64))


@dataclass(frozen=True)
class LineConfig:
    sentences: bool = True  #: sentences inside lines are units, too
    min_words: int = 6  #: of a sentence that is a unit beside its line
    min_bytes: int = 48  #: of a sentence with fewer words, so that scripts without spaces have units too


def _unit_hash(codes: np.ndarray, begin: np.ndarray, end: np.ndarray, base: np.uint64, inverse: np.uint64) -> np.ndarray:
    run = np.empty(len(codes) + 1, V.U64)
    run[0] = 0
    np.cumsum(codes * V.powers(len(codes), base), out=run[1:])
    return V.mix((run[end] - run[begin]) * V.powers(len(codes) + 1, inverse)[begin] + (end - begin).astype(V.U64))


def unit_rows(config: LineConfig):
    def run(batches):
        for batch, raw, at in V.chunks(batches):
            found = V.words(raw, at)
            n = len(found.begin)
            codes = V.slice_hash(V.prefix_hash(V.LOWER[raw]), found.begin, found.end)
            feeds = np.zeros(len(raw) + 1, np.int64)
            np.cumsum(raw == 10, out=feeds[1:])
            last = np.zeros(n, bool)  # of a line: a line feed or the text's end follows
            if n:
                last[:-1] = feeds[found.begin[1:]] > feeds[found.end[:-1]]
                last[found.first[1:][found.counts > 0] - 1] = True
            stop = last | np.isin(raw[found.end - 1], np.frombuffer(b".!?", np.uint8)) if n else last
            chars = np.zeros(len(raw) + 1, np.int64)
            np.cumsum((raw & 0xC0) != 0x80, out=chars[1:])
            line_end, part_end = np.flatnonzero(last) + 1, np.flatnonzero(stop) + 1
            line_begin, part_begin = (np.concatenate([[0], x[:-1]]).astype(np.int64) if len(x) else x for x in (line_end, part_end))
            inner = np.full(len(part_end), config.sentences) & ~(last[part_end - 1] & np.isin(part_begin, line_begin))  # a sentence that is its whole line is no unit of its own
            begin, end = np.concatenate([line_begin, part_begin[inner]]), np.concatenate([line_end, part_end[inner]])
            size = found.end[end - 1] - found.begin[begin] if n else end
            good = (np.arange(len(begin)) < len(line_begin)) | (end - begin >= config.min_words) | (size >= config.min_bytes)
            begin, end = begin[good], end[good]
            text = np.searchsorted(found.first, begin, "right") - 1
            origin = chars[at[text]]
            ids = batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(text))
            one, two = _unit_hash(codes, begin, end, V.BASE, V._inverse), _unit_hash(V.mix(codes), begin, end, _SECOND, _SECOND_INVERSE)
            low, high = (chars[found.begin[begin]] - origin, chars[found.end[end - 1]] - origin) if n else (begin, end)
            yield pa.RecordBatch.from_arrays([ids, pa.array(V.signed(one)), pa.array(V.signed(two)), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], names=["doc_id", "h1", "h2", "low", "high"])

    return run


def removals(docs: DataFrame, config: LineConfig = LineConfig()) -> DataFrame:
    """docs: doc_id (long), text. A row for each occurrence that goes: doc_id, low, high, first_doc_id, first_low, and its digest h1.

    Shuffles: digests to their first occurrence (pre-aggregated), then the occurrences to the digests that have several;
    texts stay where they are. A line that a third of all documents hold is one digest, whose occurrences a skewed join splits.
    """
    docs = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    units = docs.mapInArrow(unit_rows(config), "doc_id long, h1 long, h2 long, low int, high int")
    first = units.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "low")).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = written(first.select("h1", "h2", F.col("first.doc_id").alias("first_doc_id"), F.col("first.low").alias("first_low")), "first")
    return units.join(first, ["h1", "h2"]).where("doc_id <> first_doc_id or low <> first_low").select("doc_id", "low", "high", "first_doc_id", "first_low", "h1")


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without its spans; a line that they leave without text goes with its line feed, other empty lines stay."""
    out, at, k = [], 0, 0
    for line in text.split("\n"):
        end, left, here = at + len(line), [], at
        while k < len(spans) and spans[k][0] < end:
            low, high = spans[k]
            left.append(text[here : max(low, here)])
            here = max(here, min(high, end))
            if high > end:
                break
            k += 1
        left.append(text[here:end])
        rest = "".join(left)
        if here == at or rest.strip():
            out.append(rest)
        at = end + 1
    return "\n".join(out)


def cut(batches):
    """Rows doc_id, text, removed, h1: texts without their spans. A span is of this text if the digest there is its own."""
    for batch, raw, at in V.chunks(batches):
        found = V.words(raw, at)
        codes = V.slice_hash(V.prefix_hash(V.LOWER[raw]), found.begin, found.end)
        chars = np.zeros(len(raw) + 1, np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=chars[1:])
        spans = batch.column(2)
        text = np.repeat(np.arange(batch.num_rows), np.diff(spans.offsets.to_numpy()))
        flat = spans.flatten()
        low, high, h1 = (flat.field(k).to_numpy() for k in ("low", "high", "h1"))
        begins, ends = chars[found.begin], chars[found.end]
        i, j = np.searchsorted(begins, low + chars[at[text]]), np.searchsorted(ends, high + chars[at[text]])
        if not len(begins):
            continue
        i, j = np.minimum(i, len(begins) - 1), np.minimum(j, len(ends) - 1)
        own = (begins[i] == low + chars[at[text]]) & (ends[j] == high + chars[at[text]]) & (i <= j)
        own[own] = V.signed(_unit_hash(codes, i[own], j[own] + 1, V.BASE, V._inverse)) == h1[own]
        flat, counts = flat.filter(pa.array(own)), np.bincount(text[own], minlength=batch.num_rows)
        offsets = np.concatenate([[0], np.cumsum(counts)])
        low, high, out = low[own].tolist(), high[own].tolist(), []
        for k, whole in enumerate(batch.column(1).to_pylist()):
            mine = slice(offsets[k], offsets[k + 1])
            out.append(_without(whole, sorted(zip(low[mine], high[mine]))))
        kept = pa.StructArray.from_arrays([flat.field(k) for k in NAMES], NAMES)
        removed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), kept)
        some = pa.array(counts > 0)
        yield pa.RecordBatch.from_arrays([x.filter(some) for x in (batch.column(0), pa.array(out, pa.string()), removed)], names=["doc_id", "text", "removed"])


NAMES = ["low", "high", "first_doc_id", "first_low"]


def dedup_lines(docs: DataFrame, config: LineConfig = LineConfig()) -> DataFrame:
    """A row for each document that loses something: doc_id, text (what is left), removed (its spans, with the kept occurrence of each)."""
    docs = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    by_doc = removals(docs, config).groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct(*NAMES, "h1"))).alias("removed"))
    kind = "array<struct<low:int,high:int,first_doc_id:bigint,first_low:int>>"
    return docs.join(by_doc, "doc_id").select("doc_id", "text", "removed").mapInArrow(cut, f"doc_id long, text string, removed {kind}")
