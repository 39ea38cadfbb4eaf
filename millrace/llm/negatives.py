"""Operator 13: hard negatives by product quantisation with rigorous bounds.

1. A component c becomes the whole number floor(scale * c). Vectors are cut into `parts`; for each part, `centres` are
   fitted on a bounded sample. Each row is stored as the nearest centre of each part, with the length of what the centre
   leaves over in each part, beside its vector.
2. A score is an inner product. Looked up from an anchor's products with the centres, it is off by at most the sum over
   the parts of the anchor's length times the stored length. So a row that cannot be in a window is known by its code alone.
3. Anchors go through the index in blocks, a pass for each block; a task keeps, for each anchor of the block, the best rows it has
   seen, so a pass returns a few rows for each anchor and task, and merges them by a window on the anchor.
   The first pass finds positives: the best rows of the anchor's label. The second finds, for each of them, the best
   rows of other labels in its window of scores. Whatever the bounds do not rule out is scored exactly, in whole numbers.

A row takes no part if its id, label or vector is null, or its vector is empty, or holds null, an entry that is not
finite, or one so large that scale * c reaches 2**26 (sums of products then stay exact). Rows that repeat id, label and
vector count once; rows of one id that differ are rows of their own, but never partners of each other. Only vectors of one length
meet. An anchor without a positive, or a positive without a negative in its window, gives no rows; so a negative positive_score gives
none, as its window is empty. Ties go to the smaller id, then to the smaller label and vector. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import vectors as V
from .tables import written


@dataclass(frozen=True)
class NegativeConfig:
    scale: int = 256
    positives: int = 5
    negatives: int = 5
    low: int = 80  #: of 100: the least share of the positive's score that a negative may have
    high: int = 100
    parts: int = 32  #: two dimensions of 64 each: what the centres leave over is small beside the scores
    centres: int = 256
    sample: int = 20_000  #: most rows that centres are fitted on; every row is indexed
    turns: int = 12  #: of the fit
    block: int = 1024  #: anchors that go through the index at once
    rows: int = 2048  #: rows of the index that are scored at once
    seed: int = 13


def fit_centres(x: np.ndarray, config: NegativeConfig) -> list[np.ndarray]:
    """Centres of each part by Lloyd's rounds on a sample; a part has at most as many as there are vectors that differ in it."""
    rng = np.random.default_rng(config.seed)
    out = []
    for part in np.array_split(x.astype(np.float64), min(config.parts, x.shape[1]), axis=1):
        some = np.unique(part, axis=0)
        c = some[rng.permutation(len(some))[: config.centres]]
        for _ in range(config.turns):
            near = nearest(part, c)
            count = np.bincount(near, minlength=len(c))
            sums = np.zeros_like(c)
            np.add.at(sums, near, part)
            c = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], c)
        out.append(c)
    return out


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, in slices."""
    half = (centres**2).sum(axis=1) / 2
    return np.concatenate([np.argmax(x[k : k + 4096] @ centres.T - half, axis=1) for k in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


def encode_rows(centres: list[np.ndarray]):
    """Adds code and left: the nearest centre of each part, and the length of what is left over, rounded up."""

    def run(batches):
        for batch in batches:
            size = sum(c.shape[1] for c in centres)
            x = batch.column(batch.schema.get_field_index("x")).flatten().to_numpy().reshape(-1, size)
            at, codes, left = 0, [], []
            for c in centres:
                part = x[:, at : at + c.shape[1]].astype(np.float64)
                near = nearest(part, c)
                codes.append(near)
                left.append(np.linalg.norm(part - c[near], axis=1) * (1 + 1e-12))
                at += c.shape[1]
            code, rest = np.stack(codes, axis=1).astype(np.int16), np.stack(left, axis=1)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), len(centres)).cast(pa.list_(k)) for v, k in ((code, pa.int16()), (rest, pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=[*batch.schema.names, "code", "left"])

    return run


@dataclass
class Block:
    """Anchors that pass the index together: their rows, and what their products with the centres are."""

    ids: np.ndarray
    rows: np.ndarray  #: numbers of the anchors' rows
    labels: np.ndarray
    x: np.ndarray
    tables: list[np.ndarray]  #: of each part: centres times anchors
    lengths: np.ndarray  #: parts times anchors

    @staticmethod
    def of(ids, rows, labels, x: np.ndarray, centres: list[np.ndarray]) -> Block:
        tables, lengths, at = [], [], 0
        for c in centres:
            part = x[:, at : at + c.shape[1]].astype(np.float64)
            tables.append(c @ part.T)
            lengths.append(np.linalg.norm(part, axis=1) * (1 + 1e-12))
            at += c.shape[1]
        return Block(np.asarray(ids), np.asarray(rows), np.asarray(labels), x, tables, np.stack(lengths))


def slices(n: int, most: int) -> Iterator[tuple[int, int]]:
    """Slices of n rows: a small one first, as what it finds spares the others work."""
    low, size = 0, max(1, most // 16)
    while low < n:
        yield low, size
        low, size = low + size, most


def scored(batches, block: Block, config: NegativeConfig) -> Iterator[tuple]:
    """Slices of the index: ids, row numbers, labels, vectors, and for each row and anchor the looked-up score and how far it may be off."""
    for whole in batches:
        for low, size in slices(whole.num_rows, config.rows):
            batch = whole.slice(low, size)
            ids, rows, labels = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("vec_id", "row", "kind"))
            x, code, left = (batch.column(batch.schema.get_field_index(c)).flatten().to_numpy().reshape(len(ids), -1) for c in ("x", "code", "left"))
            score = np.zeros((len(ids), len(block.ids)))
            for k, table in enumerate(block.tables):
                score += table[code[:, k]]
            off = left @ block.lengths
            off += (np.abs(score) + off) * 1e-9 + 1e-6  # what doubles round
            yield ids, rows, labels, x, score, off


class Best:
    """The best few of each of n windows, by falling score, then rising id and row."""

    def __init__(self, n: int, keep: int):
        self.keep, self.floor = keep, np.full(n, -np.inf)  #: floor: the score of the last that counts, once there are enough
        self.window, self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(4))

    def add(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if not len(window):
            return
        w, s, i, r = (np.concatenate(x) for x in ((self.window, window), (self.score, score), (self.id, ids), (self.row, rows)))
        order = np.lexsort((r, i, -s, w))
        w, s, i, r = w[order], s[order], i[order], r[order]
        rank = np.arange(len(w)) - np.searchsorted(w, w)
        good = rank < self.keep
        self.window, self.score, self.id, self.row, rank = w[good], s[good], i[good], r[good], rank[good]
        last = rank == self.keep - 1
        self.floor[self.window[last]] = self.score[last]


def exact(x: np.ndarray, i: np.ndarray, block: Block, j: np.ndarray) -> np.ndarray:
    return np.concatenate([np.einsum("ij,ij->i", x[i[k : k + 65536]], block.x[j[k : k + 65536]]) for k in range(0, len(i), 65536)] or [np.zeros(0, np.int64)])


def best_positives(block: Block, config: NegativeConfig):
    """Of a task: for each anchor its best rows of the same label; anchor is the row number."""

    def run(batches):
        best = Best(len(block.ids), config.positives)
        for ids, rows, labels, x, score, off in scored(batches, block, config):
            can = (labels[:, None] == block.labels) & (ids[:, None] != block.ids)
            i, j = np.nonzero(can & (score + off >= best.floor))
            best.add(j, exact(x, i, block, j), ids[i], rows[i])
        yield pa.RecordBatch.from_arrays([pa.array(block.rows[best.window]), pa.array(block.ids[best.window]), pa.array(best.id), pa.array(best.row), pa.array(best.score)], names=["anchor_row", "anchor_id", "id", "row", "score"])

    return run


def best_negatives(block: Block, windows: list[tuple[int, int, int]], config: NegativeConfig):
    """windows: place of an anchor in the block, number of its positive, the positive's score. Of a task: for each window its best rows of other labels, by place and number."""
    anchor, number, top = (np.array(v, np.int64) for v in zip(*windows))
    deep = int(number.max()) + 1
    score_of = np.zeros((len(block.ids), deep), np.int64)
    upper, lower = np.full((2, len(block.ids), deep), -np.inf)  # nothing is below the upper end of a window that is not there
    score_of[anchor, number] = top
    upper[anchor, number], lower[anchor, number] = top * config.high / 100, top * config.low / 100

    def run(batches):
        best = Best(len(block.ids) * deep, config.negatives)
        for ids, rows, labels, x, score, off in scored(batches, block, config):
            least, most = score - off, score + off
            most[(labels[:, None] == block.labels) | (ids[:, None] == block.ids)] = -np.inf
            for k in range(deep):  # one window of each anchor
                floor = np.maximum(best.floor[k::deep], lower[:, k])
                floor[np.isneginf(floor)] = np.finfo(float).min
                i, j = np.nonzero((most >= floor) & (least <= upper[:, k]))
                s = exact(x, i, block, j)
                fits = (100 * s >= config.low * score_of[j, k]) & (100 * s <= config.high * score_of[j, k])
                i, j, s = i[fits], j[fits], s[fits]
                best.add(j * deep + k, s, ids[i], rows[i])
        yield pa.RecordBatch.from_arrays([pa.array(best.window // deep), pa.array(best.window % deep), pa.array(best.id), pa.array(best.row), pa.array(best.score)], names=["place", "number", "id", "row", "score"])

    return run


def sound_rows(rows: DataFrame, config: NegativeConfig) -> DataFrame:
    """vec_id, label, x of the rows that take part, each once."""
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    good &= F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * config.scale) < float(1 << 26)))
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * config.scale))
    return rows.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), "label", whole.alias("x")).distinct()


@dataclass
class Index:
    """Rows of one length of vector: vec_id, row (a number of its own), kind (a number of its label), label, x, code, left, anchor."""

    table: DataFrame
    centres: list[np.ndarray]


def build(sound: DataFrame, anchors: F.Column | None, config: NegativeConfig) -> list[Index]:
    """An index for each length of vector. sound: vec_id, label, x; each row is in it, whatever the sample was."""
    kind = F.xxhash64(F.col("label").cast("string"))
    numbered = sound.select("vec_id", kind.alias("kind"), "label", "x", F.coalesce(anchors, F.lit(False)).alias("anchor"), F.size("x").alias("size"))
    # a row's number goes up with its label and vector among rows of one id; a hash of them would tie by chance only
    repeated = Window.partitionBy("vec_id").orderBy("label", "x")
    numbered = written(numbered.withColumn("row", F.row_number().over(repeated).cast("long")), "rows")
    out = []
    for (size,) in sorted(numbered.select("size").distinct().collect()):
        own = numbered.where(F.col("size") == size).drop("size")
        sample = own.select("x", F.xxhash64("vec_id", "row").alias("h")).orderBy("h", "x").limit(config.sample).select("x").toPandas()
        centres = fit_centres(np.array(sample["x"].tolist(), np.int64), config)
        coded = own.mapInArrow(V.trimmed(encode_rows(centres)), T.StructType([*own.schema.fields, T.StructField("code", T.ArrayType(T.ShortType())), T.StructField("left", T.ArrayType(T.DoubleType()))]))
        out.append(Index(written(coded, "index"), centres))
    return out


def _blocks(index: Index, config: NegativeConfig) -> Iterator[Block]:
    """Blocks of about config.block anchors; no more than one of them is on the driver."""
    anchors = index.table.where("anchor").select("vec_id", "row", "kind", "x")
    n = anchors.count()
    parts = max(1, -(-n // config.block))
    dealt = written(anchors.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts))), "anchors")
    for k in range(parts):
        some = dealt.where(F.col("part") == k).orderBy("vec_id", "row").toPandas()
        for low in range(0, len(some), 2 * config.block):
            piece = some[low : low + 2 * config.block]
            yield Block.of(piece["vec_id"].to_numpy(np.int64), piece["row"].to_numpy(np.int64), piece["kind"].to_numpy(np.int64), np.array(piece["x"].tolist(), np.int64).reshape(len(piece), -1), index.centres)


#: What rows of windows are called.
MINED = "anchor_id long, anchor_row long, positive_id long, positive_row long, rank int, negative_id long, negative_row long, positive_score long, negative_score long"


def _pass(index: Index, block: Block, config: NegativeConfig) -> DataFrame:
    table = index.table.select("vec_id", "row", "kind", "x", "code", "left")
    found = table.mapInArrow(V.trimmed(best_positives(block, config)), "anchor_row long, anchor_id long, id long, row long, score long")
    order = [F.desc("score"), F.asc("id"), F.asc("row")]
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("anchor_id", "anchor_row").orderBy(*order))).where(F.col("rank") <= config.positives)
    positives = written(found, "positives")
    place = {key: k for k, key in enumerate(zip(block.ids.tolist(), block.rows.tolist()))}
    windows = [(place[r["anchor_id"], r["anchor_row"]], r["rank"] - 1, r["score"]) for r in positives.select("anchor_id", "anchor_row", "rank", "score").collect()]
    if not windows:
        return index.table.sparkSession.createDataFrame([], MINED)
    ids = index.table.sparkSession.createDataFrame([(k, i, r) for (i, r), k in place.items()], "place long, anchor_id long, anchor_row long")
    seen = table.mapInArrow(V.trimmed(best_negatives(block, windows, config)), "place long, number long, id long, row long, score long")
    seen = seen.withColumn("at", F.row_number().over(Window.partitionBy("place", "number").orderBy(*order))).where(F.col("at") <= config.negatives)
    seen = seen.join(F.broadcast(ids), "place").select("anchor_id", "anchor_row", (F.col("number") + 1).cast("int").alias("rank"), "at", F.col("id").alias("negative_id"), F.col("row").alias("negative_row"), F.col("score").alias("negative_score"))
    both = positives.withColumnsRenamed({"id": "positive_id", "row": "positive_row", "score": "positive_score"}).join(seen, ["anchor_id", "anchor_row", "rank"])
    return both.select("anchor_id", "anchor_row", "positive_id", "positive_row", F.col("at").cast("int").alias("rank"), "negative_id", "negative_row", "positive_score", "negative_score")


def mine(rows: DataFrame, anchors: F.Column, config: NegativeConfig = NegativeConfig()) -> DataFrame:
    """rows: vec_id (long), embedding (array of float or double), label; anchors: which vec_id are queries. Returns MINED.

    Two passes over the index for each block of anchors, without a shuffle of the index; what a block brings to the driver are its
    vectors and at most `positives` scores for each of them. Passes grow with the number of anchors, as the work of any exact search does.
    """
    sound = sound_rows(rows, config)
    spark = rows.sparkSession
    out = [written(_pass(index, block, config), "mined") for index in build(sound, anchors, config) for block in _blocks(index, config) if len(block.ids)]
    if not out:
        return spark.createDataFrame([], MINED)
    whole = out[0]
    for part in out[1:]:
        whole = whole.union(part)
    return whole
