"""Operator 12: embedding whitening with principal components by LOBPCG.

1. A component c becomes the whole number floor(scale * c) + shift. The vectors that differ are the list to fit on;
   their number n and sums S are exact.
2. A round multiplies the covariance with a block of directions: each task centres its rows as (n * x - S) / n, whose
   numerator is exact, and adds up the products; the block's size, not the data's, comes to the driver. The block holds the
   iterate, its residuals and the directions of the last step; Rayleigh-Ritz on it gives the next iterate.
3. Rounds end when the residuals of all wanted components, from a product with the iterate itself, are at the limit
   of double precision, or stop falling below `certified` of the largest eigenvalue.
4. Rows are whitened: (x - S / n) on each component, over the root of its eigenvalue. One more pass over the list
   measures how far the covariance of what comes out is from the identity.

Vectors of each length are a list of their own, with their own components. A row is left out if its vector is null, or
holds null or an entry that is not finite, or one so large that scale * c reaches 2**40. Empty vectors have no components
and give no rows, as do directions in which nothing varies (eigenvalue below `zero` of the trace), so also lists of one
vector. Rows that repeat an id are returned each; vec_id may be null. Other columns are left out.
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
class WhitenConfig:
    components: int = 16
    guard: int = 8  #: directions beside the wanted ones, which speed up the last of them
    scale: int = 64
    shift: int = 1_000_000
    rounds: int = 500
    certified: float = 1e-10  #: largest residual of a component, as a part of the largest eigenvalue
    zero: float = 1e-12
    seed: int = 12


def matrices(column: pa.Array):
    """For each length of vector in a batch: the places of its rows, and its vectors as rows."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        yield int(size), rows, flat[(ends[rows] - size)[:, None] + np.arange(size)]


def _rows(out: list[tuple[int, int, int, object]], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 4, (pa.int32(), pa.int32(), pa.int32(), kind))], names=["size", "i", "j", "v"])


def sums_of(batches):
    """Of a task: for each length the number of vectors (at i = -1) and the sum of each dimension."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for size, rows, x in matrices(batch.column(0)):
            part = np.append(x.sum(axis=0), len(rows)).astype(object)  # a batch fits 64 bits, a task need not
            total[size] = total.get(size, 0) + part
    yield _rows([(size, i if i < size else -1, 0, int(v)) for size, part in total.items() for i, v in enumerate(part)], pa.int64())


@dataclass
class Moments:
    """The vectors of one length: their number and the sums of their dimensions."""

    n: int
    sums: list[int]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly: in 64 bits, or as Python's numbers where those could overflow."""
        most = self.n * max(int(np.abs(x).max()), 1) + max(map(abs, self.sums))
        if most < 1 << 62:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)


def squares(deviations: np.ndarray) -> list[int]:
    """Sum of squares of each row, exactly."""
    if deviations.dtype != object and float(np.abs(deviations).max(initial=0)) ** 2 * deviations.shape[1] >= 2.0**62:
        deviations = deviations.astype(object)
    return (deviations * deviations).sum(axis=1).tolist()


def block_products(moments: dict[int, Moments], blocks: dict[int, np.ndarray], gram: bool = False):
    """Of a task: for each length the sum over its rows of row * (row @ block), or of (row @ block) with itself."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, x in matrices(batch.column(0)):
                if size in blocks:
                    c = moments[size].centred(x)
                    y = c @ blocks[size]
                    total[size] = total.get(size, 0) + ((y if gram else c).T @ y)
        yield _rows([(size, int(i), int(j), float(v)) for size, part in total.items() for (i, j), v in np.ndenumerate(part)], pa.float64())

    return run


def _sum(vectors: DataFrame, run, kind: str) -> dict[int, dict[tuple[int, int], object]]:
    """What tasks add up, summed by place: as many rows as a block has entries."""
    out: dict[int, dict[tuple[int, int], object]] = {}
    total = F.sum(F.col("v").cast("decimal(38,0)")) if kind == "long" else F.sum("v")
    for size, i, j, v in vectors.mapInArrow(run, f"size int, i int, j int, v {kind}").groupBy("size", "i", "j").agg(total).collect():
        out.setdefault(size, {})[i, j] = v
    return out


@dataclass
class Components:
    """Of one length of vector: unit eigenvectors as columns, by falling eigenvalue, and what certifies them."""

    moments: Moments
    vectors: np.ndarray
    values: np.ndarray
    residuals: np.ndarray
    trace: float
    rounds: int
    identity_error: float = 0.0

    @property
    def whitener(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def _basis(blocks: list[np.ndarray]) -> np.ndarray:
    """Orthonormal columns that span the blocks; the first block keeps its place, and what others add is taken twice off what is there."""
    q = np.linalg.qr(blocks[0])[0]
    for b in blocks[1:]:
        for _ in range(2):
            norms = np.linalg.norm(b, axis=0)
            b = b[:, norms > 0] / norms[norms > 0]
            b = b - q @ (q.T @ b)
        u, s, _ = np.linalg.svd(b, full_matrices=False)
        room = q.shape[0] - q.shape[1]
        add = u[:, s > 1e-10][:, :room]
        q = np.linalg.qr(np.hstack([q, add - q @ (q.T @ add)]))[0] if add.shape[1] else q
    return q


@dataclass
class _Search:
    """LOBPCG on one length: what the next product is asked of, and what follows from it."""

    size: int
    wanted: int
    config: WhitenConfig
    basis: np.ndarray
    iterate: np.ndarray | None = None
    best: float = np.inf
    still: int = 0
    final: bool = False

    def step(self, product: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """product: covariance times basis. Returns values, vectors and residuals when they are certified."""
        m = self.basis.T @ product
        values, turn = np.linalg.eigh((m + m.T) / 2)
        turn = turn[:, ::-1][:, : min(self.wanted + self.config.guard, self.size)]
        values = values[::-1][: turn.shape[1]]
        x, vx = self.basis @ turn, product @ turn
        residual = vx - x * values
        norms = np.linalg.norm(residual, axis=0)[: self.wanted]
        top = max(values[0], np.finfo(float).tiny)
        worst = norms.max() / top
        if self.final:
            return (values[: self.wanted], x[:, : self.wanted], norms) if worst <= self.config.certified else self._on(x, residual)
        self.still = 0 if worst < self.best / 2 else self.still + 1
        self.best = min(self.best, worst)
        if worst <= 4 * np.finfo(float).eps * np.sqrt(self.size) or self.still >= 4 and worst <= self.config.certified:
            self.final, self.basis, self.iterate = True, np.linalg.qr(x)[0], x  # a product with the iterate alone certifies it
            return None
        return self._on(x, residual)

    def _on(self, x: np.ndarray, residual: np.ndarray) -> None:
        self.final = False
        blocks = [x, residual]
        if self.iterate is not None:
            blocks.append(self.iterate - x @ (x.T @ self.iterate))
        self.iterate, self.basis = x, _basis(blocks)


def fit(vectors: DataFrame, config: WhitenConfig = WhitenConfig()) -> dict[int, Components]:
    """vectors: one column of arrays of whole numbers, each once, best as a written table, as each round reads it. One job a round for all lengths together."""
    counted = _sum(vectors, sums_of, "long")
    moments = {size: Moments(int(v[-1, 0]), [int(v[i, 0]) for i in range(size)]) for size, v in counted.items()}
    rng = np.random.default_rng(config.seed)
    searches = {}
    for size, m in sorted(moments.items()):
        wanted = min(config.components, size)
        start = np.linalg.qr(rng.standard_normal((size, min(wanted + config.guard, size))))[0]
        searches[size] = _Search(size, wanted, config, start)
    traces: dict[int, float] = {}
    if moments:
        total = vectors.mapInArrow(square_sums(moments), "size int, i int, j int, v string").groupBy("size").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
        traces = {r["size"]: float(r["v"]) / moments[r["size"]].n ** 3 for r in total.collect()}
        searches = {k: s for k, s in searches.items() if traces[k] > 0}
    out: dict[int, Components] = {}
    for k in range(config.rounds):
        if not searches:
            break
        got = _sum(vectors, block_products(moments, {size: s.basis for size, s in searches.items()}), "double")
        for size, s in list(searches.items()):
            product = np.zeros(s.basis.shape)
            for (i, j), v in got[size].items():
                product[i, j] = v
            if found := s.step(product / moments[size].n):
                values, axes, norms = found
                keep = values > config.zero * traces[size]
                axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
                out[size] = Components(moments[size], axes[:, keep], values[keep], norms[keep], traces[size], k + 1)
                del searches[size]
    if searches:
        raise RuntimeError(f"no certified components after {config.rounds} rounds for vectors of length {sorted(searches)}; best residuals {[s.best for s in searches.values()]}")
    got = _sum(vectors, block_products(moments, {size: c.whitener for size, c in out.items()}, gram=True), "double") if out else {}
    for size, c in out.items():
        c.identity_error = max(abs(v / c.moments.n - (i == j)) for (i, j), v in got[size].items())
    return out


def square_sums(moments: dict[int, Moments]):
    """Of a task: for each length the sum of all squared deviations, as digits."""

    def run(batches):
        total: dict[int, int] = {}
        for batch in batches:
            for size, _, x in matrices(batch.column(0)):
                total[size] = total.get(size, 0) + sum(squares(moments[size].deviations(x)))
        yield _rows([(size, 0, 0, str(v)) for size, v in total.items()], pa.string())

    return run


def whiten_rows(found: dict[int, Components]):
    """Batches of vec_id, x to a row for each component."""

    def run(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, 4096):
                batch = whole.slice(low, 4096)
                ids = batch.column(0)
                for size, rows, x in matrices(batch.column(1)):
                    if size not in found:
                        continue
                    c = found[size]
                    d = c.moments.deviations(x)
                    w = (d / c.moments.n).astype(np.float64) @ c.whitener
                    k = w.shape[1]
                    columns = [
                        ids.take(pa.array(np.repeat(rows, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(rows) * k, c.moments.n)),
                        pa.array(np.repeat(np.array([str(v) for v in squares(d)], object), k), pa.string()),
                        pa.array(w.ravel()),
                        pa.array(np.tile(c.values / c.trace, len(rows))),
                        pa.array(np.full(len(rows) * k, c.identity_error)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


@dataclass
class Whitened:
    rows: DataFrame  #: vec_id, component, n, deviation (decimal), whitened, explained, identity_error
    components: dict[int, Components]


def whole_numbers(rows: DataFrame, config: WhitenConfig) -> DataFrame:
    """vec_id and x of the rows whose vector is sound."""
    scaled = F.transform("embedding", lambda c: F.floor(c.cast("double") * config.scale))
    sound = F.col("embedding").isNotNull() & F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * config.scale) < float(1 << 40)))
    return rows.where(sound).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(scaled, lambda x: x + F.lit(config.shift).cast("long")).alias("x"))


def whiten(rows: DataFrame, config: WhitenConfig = WhitenConfig()) -> Whitened:
    """rows: vec_id (long), embedding (array of float or double). One shuffle, of the vectors to find those that differ; each round sums a block of products."""
    sound = whole_numbers(rows, config)
    vectors = written(sound.select("x").where(F.size("x") > 0).distinct(), "vectors")
    found = fit(vectors, config)
    out = sound.mapInArrow(V.trimmed(whiten_rows(found)), "vec_id long, component int, n long, deviation string, whitened double, explained double, identity_error double")
    return Whitened(out.withColumn("deviation", F.col("deviation").cast("decimal(38,0)")), found)
