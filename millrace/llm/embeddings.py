"""Operator 9: embedding near-dedup by PCA-ordered tiled comparison.

1. Vectors are scaled to length 1 in double precision; equal vectors of a label form a class, and one of a class goes on.
2. The eigenvectors of the second-moment matrix of all vectors turn them, so that the leading dimensions hold most of
   their length. The turn keeps all products.
3. Links at cosine t lie within sqrt(2 - 2t) of each other, and so do their leading dimensions. Cells of that width over
   the first dimensions hold tiles of bounded size; only tiles of a cell and its neighbours meet.
4. A pair of tiles adds up products dimension by dimension, in blocks. What is left of a product is at most the product
   of the two vectors' remaining norms, so a pair of vectors is dropped as soon as it cannot reach t, and rows and columns without
   a pair left go too. Survivors are decided by the cosine of their original vectors in double precision.
5. A pair of tiles returns for each vector how many it links with and the smallest it reaches there: as many rows as
   vectors, however many links there are. These join into components.

A vector links with nothing if it or its label is null, if it is zero or empty, or if it holds null or a component that
is not finite; vectors of unlike lengths never link. Rows with a null id are returned unlinked and kept. Repeated ids
count as one vector of that id if the vectors are equal.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .tables import written


@dataclass(frozen=True)
class CosineConfig:
    threshold: float = 0.98
    tile: int = 1024  #: vectors in a tile, about
    cell_dims: int = 2  #: leading dimensions that make cells
    block_dims: int = 8  #: dimensions added up between two looks at the bounds


def _matrix(column: pd.Series) -> np.ndarray:
    """Vectors of one length as rows. Each is scaled by a power of two, which changes no cosine, so that no square overflows or vanishes."""
    x = np.concatenate(column.to_numpy()).astype(np.float64).reshape(len(column), -1)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _moments(batches):
    """Of each task: sums of products of the dimensions, a row for each pair of them and length of vector."""
    total: dict[int, np.ndarray] = {}
    for frame in batches:
        for size, part in frame.groupby(frame["embedding"].str.len()):
            x = _matrix(part["embedding"])
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            total[size] = total.get(size, 0) + x.T @ x
    for size, m in total.items():
        i, j = np.triu_indices(size)
        yield pd.DataFrame({"size": size, "i": i, "j": j, "v": m[i, j]})


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vector: eigenvectors of the second-moment matrix as columns, the strongest first. Over all rows; what comes to the driver is dimensions squared."""
    sums = vectors.select("embedding").mapInPandas(_moments, "size int, i int, j int, v double").groupBy("size", "i", "j").agg(F.sum("v").alias("v")).toPandas()
    out = {}
    for size, part in sums.groupby("size"):
        m = np.zeros((size, size))
        m[part["i"], part["j"]] = m[part["j"], part["i"]] = part["v"]
        out[int(size)] = np.linalg.eigh(m)[1][:, ::-1]
    return out


def survivors(a: np.ndarray, b: np.ndarray, threshold: float, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of turned unit vectors whose product may reach the threshold."""
    dims = a.shape[1]
    rows, columns = np.arange(len(a)), np.arange(len(b))
    got = np.zeros((len(a), len(b)))
    rest_a, rest_b = (np.sqrt(np.maximum(np.cumsum((x**2)[:, ::-1], axis=1)[:, ::-1], 0)) for x in (a, b))
    for low in range(0, dims, block):
        high = min(dims, low + block)
        got += a[rows, low:high] @ b[columns, low:high].T
        if high == dims:
            break
        can = got + rest_a[rows, high][:, None] * rest_b[columns, high] >= threshold - 1e-9
        keep_r, keep_c = can.any(axis=1), can.any(axis=0)
        if can.sum() * 8 < got.size:  # few pairs are left: go on with them alone
            i, j = np.nonzero(can)
            part = got[i, j]
            i, j = rows[i], columns[j]
            for at in range(high, dims, block):
                to = min(dims, at + block)
                part = part + np.einsum("ij,ij->i", a[i, at:to], b[j, at:to])
                if to == dims:
                    rest = 0.0
                else:
                    rest = rest_a[i, to] * rest_b[j, to]
                good = part + rest >= threshold - 1e-9
                i, j, part = i[good], j[good], part[good]
            return i, j
        rows, columns, got = rows[keep_r], columns[keep_c], got[np.ix_(keep_r, keep_c)]
    i, j = np.nonzero(got >= threshold - 1e-9)
    return rows[i], columns[j]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n places the smallest place it reaches by the links i, j."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def compare_tiles(config: CosineConfig, axes: dict[int, np.ndarray]):
    def run(key, both: pd.DataFrame) -> pd.DataFrame:
        same = key[0] == key[1]
        left, right = both[both["side"] == 0], both[both["side"] == (0 if same else 1)]
        if not len(left) or not len(right):
            return pd.DataFrame({"vec_id": [], "links": [], "root": []}).astype("int64")
        x, y = _matrix(left["embedding"]), _matrix(right["embedding"])
        nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
        turn = axes[x.shape[1]]
        i, j = survivors((x / nx[:, None]) @ turn, (y / ny[:, None]) @ turn, config.threshold, config.block_dims)
        good = np.concatenate([np.einsum("ij,ij->i", x[i[k : k + 65536]], y[j[k : k + 65536]]) / (nx[i[k : k + 65536]] * ny[j[k : k + 65536]]) for k in range(0, len(i), 65536)] or [np.zeros(0)]) >= config.threshold
        i, j = i[good], j[good]
        ids = np.concatenate([left["vec_id"], right["vec_id"]])
        if same:  # both orders of a pair are there
            part = ids[i] != ids[j]
            i, j = i[part], j[part]
            n, place = np.bincount(i, right["copies"].to_numpy()[j], len(left)).astype(np.int64), j
            ids, root = ids[: len(left)], _roots(len(left), i, place)
        else:
            n = np.concatenate([np.bincount(i, right["copies"].to_numpy()[j], len(left)), np.bincount(j, left["copies"].to_numpy()[i], len(right))]).astype(np.int64)
            root = _roots(len(ids), i, j + len(left))
        # the smallest id of each local component stands for it
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, root, ids)
        some = n > 0
        return pd.DataFrame({"vec_id": ids[some], "links": n[some], "root": least[root][some]})

    return run


def near_vectors(rows: DataFrame, config: CosineConfig = CosineConfig()) -> DataFrame:
    """rows: vec_id (long), embedding (array of float or double), label. Returns vec_id, n_links, component_id, kept for each row.

    Shuffles: classes (pre-aggregated by vector), tiles to their neighbours, and a row for each vector and pair of tiles
    with links. A label with a third of all rows is many cells and tiles.
    """
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    sound = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    sound &= F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists("embedding", lambda v: v != 0)
    good = rows.where(sound)
    kind = rows.schema["label"].dataType.simpleString()
    plain = F.transform("embedding", lambda v: v + F.lit(0).cast(rows.schema["embedding"].dataType.elementType))  # -0 is 0
    classes = good.select("vec_id", "label", plain.alias("embedding")).distinct().groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = written(classes, "vectors")
    axes = principal_axes(classes)
    width, dims = math.sqrt(2 - 2 * config.threshold) + 1e-9, config.cell_dims

    def cells(frames):
        for frame in frames:
            for size, part in frame.groupby(frame["embedding"].str.len()):
                x = _matrix(part["embedding"])
                lead = np.floor((x / np.linalg.norm(x, axis=1, keepdims=True)) @ axes[size][:, :dims] / width).astype(np.int64)
                yield part.assign(**{f"c{k}": lead[:, k] if k < lead.shape[1] else 0 for k in range(dims)}, dim=size)

    cell = [f"c{k}" for k in range(dims)]
    placed = classes.select("rep", "copies", "label", "embedding").mapInPandas(cells, f"rep long, copies long, label {kind}, embedding {rows.schema['embedding'].dataType.simpleString()}, {', '.join(c + ' long' for c in cell)}, dim long")
    placed = written(placed, "placed")
    counts = placed.groupBy("label", "dim", *cell).agg(F.ceil(F.count("*") / config.tile).cast("int").alias("tiles"))
    counts = written(counts, "cells")
    name = lambda tile: F.xxhash64("label", "dim", *cell, tile)
    placed = placed.join(counts, ["label", "dim", *cell]).select(name(F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")).alias("tile"), "rep", "copies", "embedding")
    placed = written(placed, "tiled")
    one = counts.withColumn("t", F.explode(F.expr("sequence(0, tiles - 1)"))).withColumn("tile", name(F.col("t"))).select("label", "dim", *cell, "tile")
    steps = F.array(*[F.struct(*[F.lit(s).cast("long").alias(c) for s, c in zip(step, cell)]) for step in np.ndindex(*[3] * dims) for step in [tuple(s - 1 for s in step)]])
    shifted = one.withColumn("step", F.explode(steps)).select("label", "dim", *[(F.col(c) + F.col(f"step.{c}")).alias(c) for c in cell], F.col("tile").alias("left"))
    meets = shifted.join(one.withColumnRenamed("tile", "right"), ["label", "dim", *cell]).where("left <= right").select("left", "right")
    meets = written(meets, "meets")
    sides = meets.select("left", "right", F.lit(0).alias("side"), F.col("left").alias("tile")).union(meets.where("left <> right").select("left", "right", F.lit(1), "right"))
    brought = sides.join(placed, "tile").select("left", "right", "side", F.col("rep").alias("vec_id"), "copies", "embedding")
    found = brought.groupBy("left", "right").applyInPandas(compare_tiles(config, axes), "vec_id long, links long, root long")
    found = written(found, "found")
    reached = components(found.where("vec_id <> root").select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    per_class = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    final = classes.join(per_class, classes["rep"] == per_class["vec_id"], "left").drop("vec_id").join(reached, F.col("rep") == F.col("node"), "left")
    final = final.select(F.col("label").alias("class_label"), F.col("embedding").alias("class_embedding"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    plain = F.when(sound, plain)
    out = rows.withColumn("plain", plain).join(final, (F.col("label") == F.col("class_label")) & (F.col("plain") == F.col("class_embedding")), "left")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
