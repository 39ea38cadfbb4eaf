"""Operator 3: MinHash near-dedup with sequential Bayesian verification.

1. Each text becomes its set of word shingles (64-bit hashes of whole shingles), a digest of that set and a signature.
2. Texts with equal sets form a class; only one of a class goes on, so copies never multiply.
3. Signature bands put classes into buckets. Each member of a bucket is a candidate with the bucket's leader.
4. Candidates are compared signature batch by signature batch. Under a uniform prior, matches in n draws give a Beta
   posterior of the similarity; a pair goes when the posterior chance of reaching the threshold falls under the miss
   probability. Survivors are verified exactly on the full sets.
5. Links make components. A bucket that still holds several components may hide a link between members that are not its
   leader. Their members meet by the prefix filter: with shingles in one order over all of them, rarest first, two sets
   of similarity t or more share a shingle among their first n - ceil(t * n) + 1. Only members of different components
   that share such a shingle are candidates, unless a count of odd hash buckets shows in the join that their sets differ in
   too many shingles; candidates are verified as above. So no link between members of a bucket is left
   out, and pairs inside a component, which change nothing, are never made.

Null and empty texts, and texts without words, have an empty set, link with nothing and keep themselves. Rows with a
null id are returned, are linked with nothing and keep themselves. Rows that repeat an id are each linked by their own text.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .graph import components
from .tables import scratch, written


#: Bits that tell sets apart before any pair of them is made.
PARITY = 1024


@dataclass(frozen=True)
class NearConfig:
    shingle: int = 5  #: words
    numerator: int = 4  #: the threshold is numerator / denominator, so that it is met exactly
    denominator: int = 5
    bands: int = 64
    rows: int = 8  #: signature values in a band; at the threshold a pair is missed by all bands with chance (1 - t ** rows) ** bands
    compared: int = 256  #: signature values that verification may look at
    batch: int = 64  #: of them, how many at once
    shipped: int = 4_000_000  #: ids of documents to read again that are broadcast; more of them are joined by shuffle
    miss: float = 1e-6  #: posterior chance of reaching the threshold under which a pair is pruned
    seed: int = 5

    @property
    def size(self) -> int:
        return self.bands * self.rows


def shingle_sets(raw: np.ndarray, at: np.ndarray, n: int):
    """For each text its sorted distinct shingle hashes. Only A-Z are lower-cased; a text of fewer words is one shingle."""
    raw = V.LOWER[raw]
    found = V.words(raw, at)
    codes = V.slice_hash(V.prefix_hash(raw), found.begin, found.end)
    grams = V.gram_hash(codes, n)
    for low, high in zip(found.first[:-1], found.first[1:]):
        if high - low >= n:
            yield np.unique(grams[low : high - n + 1])
        elif high > low:
            yield V.mix(V.gram_hash(codes[low:high], int(high - low)) + V.U64(high - low))
        else:
            yield np.zeros(0, V.U64)


def _draws(config: NearConfig) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.RandomState(config.seed)
    return random.randint(0, 1 << 32, config.size, np.uint64).astype(np.uint32), random.randint(0, 1 << 31, config.size, np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)


def signature(grams: np.ndarray, flips: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least value of each of many hash functions; long texts are worked on in pieces."""
    out = np.full(len(flips), 0xFFFFFFFF, np.uint32)
    short = (grams >> V.U64(32)).astype(np.uint32)
    for low in range(0, len(short), 2048):
        part = (short[low : low + 2048, None] ^ flips) * factors
        np.minimum(out, part.min(axis=0), out=out)
    return out


def digest(grams: np.ndarray) -> bytes:
    """Of a set, from its sorted shingles."""
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def sketches(config: NearConfig):
    flips, factors = _draws(config)

    def run(batches):
        for batch, raw, at in V.chunks(batches):
            sizes, digests, signs, bands = [], [], [], []
            for grams in shingle_sets(raw, at, config.shingle):
                sizes.append(len(grams))
                least = signature(grams, flips, factors) if len(grams) else None
                digests.append(None if least is None else digest(grams))
                signs.append(None if least is None else (least[: config.compared] & np.uint32(255)).astype(np.uint8).tobytes())
                bands.append(None if least is None else band_buckets(least, config).tobytes())
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            marks = batch.column(batch.schema.get_field_index("mark"))
            yield pa.RecordBatch.from_arrays([ids, marks, pa.array(sizes, pa.int64()), *(pa.array(x, pa.binary()) for x in (digests, signs, bands))], names=["doc_id", "mark", "n_shingles", "digest", "sign", "bands"])

    return run


def band_buckets(least: np.ndarray, config: NearConfig) -> np.ndarray:
    """Of a signature: a hash of each band's number and values."""
    bucket = V.mix(np.arange(config.bands, dtype=V.U64) + V.U64(1))
    for column in least.reshape(config.bands, config.rows).T.astype(V.U64):
        bucket = V.mix(bucket * V.BASE + column)
    return bucket


def bucket_rows(config: NearConfig):
    """A row for each class and band."""

    def run(batches):
        for batch in batches:
            buckets = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
            node, n = (np.repeat(batch.column(i).to_numpy(), config.bands) for i in (0, 2))
            yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(node), pa.array(n)], names=["bucket", "node", "n"])

    return run


def least_matches(config: NearConfig, threshold: float) -> list[tuple[int, int]]:
    """(signature values compared, matches needed to stay): posterior of the similarity under a uniform prior, on a grid.

    Of each value one byte is compared, so unlike values agree once in 256 times."""
    grid = (np.arange(2000) + 0.5) / 2000
    high = grid >= threshold
    grid = grid + (1 - grid) / 256
    up, down = np.log(grid), np.log1p(-grid)
    out = []
    for n in range(config.batch, config.compared + 1, config.batch):
        m = np.arange(n + 1)[:, None]
        logs = m * up + (n - m) * down
        mass = np.exp(logs - logs.max(axis=1, keepdims=True))
        out.append((n, int(np.argmax(mass[:, high].sum(axis=1) / mass.sum(axis=1) >= config.miss))))
    return out


def prune(config: NearConfig):
    """Rows a, b and their signatures: the pairs that may reach the threshold."""
    needs = least_matches(config, config.numerator / config.denominator)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, config.compared) for i in (2, 3))
            alive, matches, done = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64), 0
            for n, need in needs:
                matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
                alive, done = alive[matches[alive] >= need], n
            kept = batch.take(pa.array(alive))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    return run


def full_sets(config: NearConfig):
    """Rows node, digest, text: the sets of the nodes whose digest the text has. Rows of one id may have several texts."""

    def run(batches):
        for batch, raw, at in V.chunks(batches):
            nodes, wanted = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            sets = [(node, grams.tobytes()) for node, name, grams in zip(nodes, wanted, shingle_sets(raw, at, config.shingle)) if digest(grams) == name]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in sets], pa.int64()), pa.array([x[1] for x in sets], pa.binary())], names=["node", "grams"])

    return run


#: Bytes of sets that are looked at, or shingles that are returned, at once.
PIECE = 1 << 22


def _pieces(batches, column: int):
    """Slices of batches whose values of a column have about PIECE bytes."""
    for batch in batches:
        sizes = np.cumsum([0] + [len(x.as_buffer()) for x in batch.column(column)])
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(sizes, sizes[low] + PIECE, "right")) - 1)
            yield batch.slice(low, high - low)
            low = high


def shingle_rows(batches):
    """Rows node, component, n, grams: a row for each shingle."""
    for batch in _pieces(batches, 3):
        sets = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(3)]
        sizes = [len(x) for x in sets]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(i).to_numpy(), sizes)) for i in (0, 1, 2)] + [pa.array(np.concatenate(sets))], names=["node", "component", "n", "shingle"])


def parities(batches):
    """Rows node, grams: a bit for each of PARITY buckets, set if an odd number of the set's shingles fall into it. Where two sets differ in d shingles, at most d bits differ."""
    for batch in _pieces(batches, 1):
        out = np.zeros((batch.num_rows, PARITY), np.uint8)
        for row, grams in zip(out, batch.column(1)):
            row[:] = np.bincount((np.frombuffer(grams.as_buffer(), V.U64) % V.U64(PARITY)).astype(np.int64), minlength=PARITY) & 1
        bits = np.packbits(out, axis=1).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(bits.reshape(-1)), PARITY // 64).cast(pa.list_(pa.int64()))], names=["node", "parity"])


def verify(config: NearConfig):
    """Pairs whose full sets reach the threshold, in whole numbers."""

    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), V.U64), np.frombuffer(y.as_buffer(), V.U64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(config.denominator * both >= config.numerator * (len(x) + len(y) - both))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return run


def _shipped(keys: DataFrame, config: NearConfig) -> DataFrame:
    """As a table, to be joined with texts: broadcast while it has no more than config.shipped rows, by shuffle beyond that."""
    keys = written(keys, "keys")
    return F.broadcast(keys) if keys.count() <= config.shipped else keys


def _sets(nodes: DataFrame, signs: DataFrame, docs: DataFrame, config: NearConfig) -> DataFrame:
    """node, grams: the full sets of nodes, from their texts. Texts stay where they are while the nodes are no more than config.shipped; beyond that they are joined by shuffle."""
    wanted = _shipped(nodes.join(signs, "node").select(F.col("rep").alias("doc_id"), "node", "digest"), config)
    return docs.join(wanted, "doc_id").select("node", "digest", "text").mapInArrow(full_sets(config), "node long, grams binary").dropDuplicates(["node"])


def _links(pairs: DataFrame, signs: DataFrame, docs: DataFrame, config: NearConfig) -> DataFrame:
    """pairs: distinct a < b. The links among them."""
    left, right = signs.select(F.col("node").alias("a"), F.col("sign").alias("sa")), signs.select(F.col("node").alias("b"), F.col("sign").alias("sb"))
    alive = pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb").mapInArrow(V.trimmed(prune(config)), "a long, b long")
    alive = written(alive, "alive")
    grams = written(_sets(alive.select(F.col("a").alias("node")).union(alive.select("b")).distinct(), signs, docs, config), "sets")
    full = alive.join(grams.select(F.col("node").alias("b"), F.col("grams").alias("gb")), "b").join(grams.select(F.col("node").alias("a"), F.col("grams").alias("ga")), "a")
    return written(full.select("a", "b", "ga", "gb").mapInArrow(V.trimmed(verify(config)), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, config: NearConfig = NearConfig()) -> DataFrame:
    """docs: doc_id (long), text. Returns doc_id, n_shingles, component_id, kept for each row.

    Shuffles: classes by digest (pre-aggregated, a row for each digest and task), buckets by a 64-bit hash, pairs by
    class, and the shingles of classes in buckets of several components. Texts are shuffled nowhere as long as the
    classes to read again are within config.shipped. A bucket with a third of all classes costs as many candidates as it has members.
    """
    return _told(docs, config).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, config: NearConfig = NearConfig()) -> DataFrame:
    """docs, with all its columns, but of each group of near duplicates only the row with the smallest doc_id. Of rows that repeat an id and its text one stays; rows without an id or without words stay."""
    key = ["doc_id", "_near_text"]
    docs = docs.withColumn("_near_text", F.xxhash64("text"))
    with scratch():
        told = written(_told(docs, config, "_near_text").where("doc_id is not null and group is not null").select("doc_id", F.col("mark").alias("_near_text"), "group"), "told")
    best = told.groupBy("group").agg(F.min(F.struct(*key)).alias("best"), F.count("*").alias("rows")).where("rows > 1")
    told = written(told.join(best, "group").select(*key, (F.struct(*key) == F.col("best")).alias("first")), "groups")
    gone, again = (_shipped(x, config) for x in (told.where("not first").select(*key).distinct(), told.where("first").groupBy(*key).count().where("count > 1").select(*key)))
    left = docs.join(gone, key, "left_anti")
    return left.join(again, key, "left_anti").unionByName(left.join(again, key, "left_semi").dropDuplicates(key)).drop("_near_text")


def _told(docs: DataFrame, config: NearConfig, mark: str | None = None) -> DataFrame:
    """doc_id, mark (what the column of that name has), n_shingles, group, component_id for each row; rows of one group are near duplicates, null is none."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col(mark) if mark else F.lit(0)).cast("long").alias("mark"), "text")
    sketch = written(docs.mapInArrow(sketches(config), "doc_id long, mark long, n_shingles long, digest binary, sign binary, bands binary"), "sketches")
    named = sketch.where("digest is not null and doc_id is not null")
    classes = named.groupBy("digest").agg(F.min("doc_id").alias("rep")).withColumn("node", F.monotonically_increasing_id())
    classes = written(classes, "classes")  # numbers of nodes hold from here on
    signs = named.join(classes, "digest").where("doc_id = rep").select("node", "rep", "digest", "sign", "bands", F.col("n_shingles").alias("n")).dropDuplicates(["node"])
    signs = written(signs, "signs")
    buckets = signs.select("node", "bands", "n").mapInArrow(V.trimmed(bucket_rows(config)), "bucket long, node long, n long")
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1").select("bucket")
    told = written(buckets.join(shared, "bucket"), "buckets")
    lead = told.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("lead"))
    pairs = told.join(lead, "bucket").where("node <> lead.node").where(_near_size(config, "n", "lead.n")).select(F.col("lead.node").alias("a"), F.col("node").alias("b")).distinct()
    pairs = written(pairs, "pairs")
    first = _links(pairs, signs, docs, config)
    second = _links(_across(told, first, pairs, signs, docs, config), signs, docs, config)
    reached = written(components(first.union(second)), "reached")
    least = reached.join(classes, "node").groupBy("component").agg(F.min("rep").alias("component_id"))
    final = classes.join(reached.join(least, "component"), "node", "left").select("digest", F.coalesce("component", "node").alias("group"), F.coalesce("component_id", "rep").alias("least"))
    out = sketch.select("doc_id", "mark", "n_shingles", "digest").join(final, "digest", "left")
    return out.select("doc_id", "mark", "n_shingles", "group", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))


def _near_size(config: NearConfig, x: str, y: str) -> str:
    """Sets of sizes this far apart cannot reach the threshold."""
    return f"{config.denominator} * least({x}, {y}) >= {config.numerator} * greatest({x}, {y})"


def _near_parity(config: NearConfig) -> str:
    """Sets that differ in so many bits of their parities cannot reach the threshold: it allows (1 - t) / (1 + t) of both sizes as difference."""
    bits = " + ".join(f"bit_count(px[{k}] ^ py[{k}])" for k in range(PARITY // 64))
    return f"({bits}) * {config.denominator + config.numerator} <= {config.denominator - config.numerator} * (nx + ny)"


def _across(told: DataFrame, links: DataFrame, asked: DataFrame, signs: DataFrame, docs: DataFrame, config: NearConfig) -> DataFrame:
    """Pairs across components, among the members of buckets that hold several, whose prefixes share a shingle; without those asked before."""
    reached = components(links)
    told = written(told.join(reached, "node", "left").select("bucket", "node", "n", F.coalesce("component", "node").alias("component")), "told")
    mixed = told.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket")
    members = written(told.join(mixed, "bucket").select("node", "component", "n").distinct(), "members")
    sets = written(members.join(_sets(members.select("node"), signs, docs, config), "node").select("node", "component", "n", "grams"), "mixed")
    rows = sets.mapInArrow(V.trimmed(shingle_rows), "node long, component long, n long, shingle long")
    counts = rows.groupBy("shingle").agg(F.count("*").alias("df"), (F.min("component") < F.max("component")).alias("across")).where("df > 1")
    found = rows.join(written(counts, "counts"), "shingle").groupBy("node", "component", "n").agg(F.sort_array(F.collect_list(F.struct("df", "shingle", "across"))).alias("s"))
    # shingles of one set alone are the rarest; they match nothing, but take up places of the prefix
    alone = F.col("n") - F.size("s")
    prefix = F.col("n") - F.ceil(F.col("n") * config.numerator / config.denominator) + 1 - alone
    first = found.where(prefix > 0).select("node", "component", "n", F.explode(F.filter(F.slice("s", F.lit(1), prefix.cast("int")), lambda x: x["across"])["shingle"]).alias("shingle"))
    first = written(first.join(sets.select("node", "grams").mapInArrow(V.trimmed(parities), "node long, parity array<long>"), "node"), "prefixes")
    largest = first.groupBy("shingle", "component").agg(F.count("*").alias("k")).groupBy("shingle").agg(F.max(F.struct("k", "component")).alias("m")).select("shingle", F.col("m.component").alias("largest"))
    # members of the component that most sets of a shingle are in do not meet each other
    minor = first.join(written(largest, "largest"), "shingle").where("component <> largest").select("shingle", F.col("node").alias("x"), F.col("component").alias("cx"), F.col("n").alias("nx"), F.col("parity").alias("px"), "largest")
    met = written(minor, "minor").join(first.select("shingle", F.col("node").alias("y"), F.col("component").alias("cy"), F.col("n").alias("ny"), F.col("parity").alias("py")), "shingle")
    met = met.where("cx <> cy and (cy = largest or x < y)").where(_near_size(config, "nx", "ny")).where(_near_parity(config))
    pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    return written(pairs.join(asked, ["a", "b"], "left_anti"), "across")
