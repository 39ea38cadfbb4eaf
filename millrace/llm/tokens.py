"""Operator 4: token ids in training order.

Texts are tokenised with a given vocabulary, each followed by an end mark, and packed into sequences of a fixed length.
A keyed Feistel permutation with cycle-walking gives every sequence a global slot; range partitions of the slots write
shards of a fixed number of sequences as little-endian 16-bit ids. A sequence's place follows from its slot by
arithmetic alone: shard slot // shard_sequences, byte slot % shard_sequences * length * 2. So training reads shards from
front to back, and resumes at any slot.

Texts are read twice: once to count the sequences of each partition, once to write them. Nothing but the sequences
is shuffled, and no copy of the ids is kept between the passes. Both passes must see the same partitions: docs is a
table scan (or any frame whose partitions do not change), the number of splits is held for both, and a partition
that differs from its count stops the job rather than write a wrong order.

Null and empty texts have no ids and no end mark. Repeated rows are tokenised each. The last sequence of a partition is
filled up with end marks; n_tokens tells how many ids are its own.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vectors as V
from .tables import new_path, small_batches, written


@dataclass(frozen=True)
class TokenConfig:
    vocabulary: str  #: path of a file of base64 tokens and ranks, as tiktoken reads
    pattern: str  #: what splits texts before merging
    end: int = 50_256  #: id that ends a text; not in the vocabulary
    length: int = 1024
    shard_sequences: int = 8192
    key: int = 0x5EED


def public_config(name: str = "byte_bpe_multi_50k.tiktoken") -> TokenConfig:
    """The vocabularies that are installed as the module public_tokenizers."""
    import public_tokenizers

    return TokenConfig(public_tokenizers.path(name), public_tokenizers.PATTERN)


def _encoder(vocabulary: bytes, config: TokenConfig):
    import sys
    import types

    import tiktoken

    # a worker serves many tasks; a module of its own outlives them, this function's globals do not
    held = sys.modules.setdefault("_millrace_encoders", types.ModuleType("_millrace_encoders")).__dict__.setdefault("held", {})
    name = (zlib.crc32(vocabulary), len(vocabulary), config.pattern)
    if name in held:
        return held[name]
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
    held[name] = tiktoken.Encoding("given", pat_str=config.pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return held[name]


def _encoded(batches, vocabulary: bytes, config: TokenConfig):
    """(doc_id, ids with the end mark) of each text that has any."""
    encode = _encoder(vocabulary, config)
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                ids = encode(text)
                ids.append(config.end)
                yield doc_id, ids
    batch = ids = text = None
    V.trim()


def count_sequences(vocabulary: bytes, config: TokenConfig):
    def run(batches):
        total = mark = 0
        for doc_id, ids in _encoded(batches, vocabulary, config):
            total += len(ids)
            mark = zlib.crc32(f"{doc_id} {total}".encode(), mark)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total], pa.int64()), pa.array([mark], pa.int64())], names=["part", "tokens", "mark"])

    return run


def pack_sequences(vocabulary: bytes, config: TokenConfig, begins: dict[int, tuple[int, int, int]], total: int):
    """begins: of each partition its first sequence, its ids and their mark."""
    size = config.length * 2

    def run(batches):
        at, tokens, expected = begins[TaskContext.get().partitionId()]
        held, owners, rows, seen, mark = bytearray(), [], [], 0, 0

        def flush():
            nonlocal at, rows
            index = np.arange(at, at + len(rows))
            slot = V.feistel(index, np.full(len(rows), total), np.full(len(rows), config.key))
            at += len(rows)
            batch = pa.RecordBatch.from_arrays([pa.array(slot), pa.array(index), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["slot", "sequence", "ids", "n_tokens", "doc_ids"])
            rows = []
            return batch

        for doc_id, ids in _encoded(batches, vocabulary, config):
            seen += len(ids)
            mark = zlib.crc32(f"{doc_id} {seen}".encode(), mark)
            held += array("H", ids).tobytes()
            owners.append(doc_id)
            low = 0
            while len(held) - low >= size:
                rows.append((bytes(held[low : low + size]), config.length, owners))
                low += size
                owners = [doc_id] if len(held) > low else []
                if len(rows) == 512:
                    yield flush()
            del held[:low]
        if held:
            rows.append((bytes(held) + np.full((size - len(held)) // 2, config.end, np.uint16).tobytes(), len(held) // 2, owners))
        if rows:
            yield flush()
        if (seen, mark) != (tokens, expected):
            raise RuntimeError("the partitions of the texts changed between counting and writing; docs must be a table scan")

    return run


def shard_uri(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:08d}.bin"


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that Spark resolves it by, so that executors write where Spark would."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return (pyarrow.fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")) if uri.startswith("file:") else pyarrow.fs.FileSystem.from_uri(uri)


def write_shards(folder: str, config: TokenConfig, total: int):
    """Rows come in order of slot and whole shards; a shard appears under its name only when it is whole, so a repeated task does no harm."""
    size = config.length * 2

    def run(batches):
        out = path = target = None
        for batch in batches:
            rows = []
            for slot, sequence, ids, n, docs in zip(*(c.to_pylist() for c in batch.columns)):
                shard, place = divmod(slot, config.shard_sequences)
                if place == 0:
                    store, target = _store(shard_uri(folder, shard))
                    path = f"{target}.part-{TaskContext.get().taskAttemptId()}"
                    store.create_dir(target.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(path)
                out.write(ids)
                if place == config.shard_sequences - 1 or slot == total - 1:
                    out.close()
                    store.move(path, target)
                rows.append((slot, shard, place * size, sequence, n, docs, zlib.crc32(ids)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 7, kinds)], names=["slot", "shard", "byte", "sequence", "n_tokens", "doc_ids", "crc32"])

    return run


@dataclass
class Shards:
    index: DataFrame  #: slot, shard, byte, sequence, n_tokens, doc_ids, crc32: a row for each sequence
    folder: str
    sequences: int
    config: TokenConfig

    def read(self, start: int = 0):
        """Sequences from a slot on, in training order, as arrays of ids."""
        size = self.config.length * 2
        for shard in range(start // self.config.shard_sequences, -(-self.sequences // self.config.shard_sequences)):
            store, path = _store(shard_uri(self.folder, shard))
            with store.open_input_file(path) as f:
                f.seek(max(0, start - shard * self.config.shard_sequences) * size)
                while part := f.read(size):
                    yield np.frombuffer(part, np.uint16)


def materialise(docs: DataFrame, config: TokenConfig, folder: str | None = None) -> Shards:
    """docs: doc_id (long), text. Writes the shards to folder, or to a new one in the shared folder, and returns them with their index.

    One shuffle, of the sequences to their shards. What comes to the driver is a row for each input partition.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with open(config.vocabulary, "rb") as f:
        vocabulary = f.read()
    folder = qualified(spark, folder or new_path(spark, "shards")).rstrip("/")
    held = spark.conf.get("spark.sql.files.minPartitionNum", None)
    spark.conf.set("spark.sql.files.minPartitionNum", str(held or max(1, docs.rdd.getNumPartitions())))
    try:
        with small_batches(spark):
            counts = sorted(docs.mapInArrow(count_sequences(vocabulary, config), "part int, tokens long, mark long").collect())
        begins, total = {}, 0
        for part, tokens, mark in counts:
            begins[part] = (total, tokens, mark)
            total += -(-tokens // config.length)
        rows = docs.mapInArrow(pack_sequences(vocabulary, config, begins, total), "slot long, sequence long, ids binary, n_tokens int, doc_ids array<long>")
        shards = max(1, -(-total // config.shard_sequences))
        dealt = rows.repartitionById(shards, F.floor(F.col("slot") / config.shard_sequences).cast("int")).sortWithinPartitions("slot")
        index = dealt.mapInArrow(V.trimmed(write_shards(folder, config, total)), "slot long, shard long, byte long, sequence long, n_tokens int, doc_ids array<long>, crc32 long")
        return Shards(written(index, "index"), folder, total, config)
    finally:
        if held is None:
            spark.conf.unset("spark.sql.files.minPartitionNum")
        else:
            spark.conf.set("spark.sql.files.minPartitionNum", held)
