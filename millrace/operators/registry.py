"""The registry of shards as an append-only log: upserts that can be repeated, illegal transitions kept out, and what they come to.

A log is a folder; each commit is a folder of Parquet below it, `v=0000000001` and so on, which appears by a rename once it
is whole. Two writers that aim at one version cannot both have it: the later works its events out again, against the state
that the first left. So a merge never loses an event, and applying events again changes nothing. A writer that dies just before
its rename leaves a lock file; upserts then fail with its name, until it is deleted.

An event is key, seq, status, payload. Events of a key are taken in order of seq, then of status. An event is `stale` if the
log has one of its key with that seq or a higher one (a replay), `illegal` if its status may not follow the key's last one
(LEGAL), and `applied` otherwise; only applied events are written. A key or a status that is null, or a status of another name, is
illegal; a null seq comes first of all, and is stale once the key is known.

What a status leads to depends on the one before, so events are folded in order: they are dealt by ranges of key and seq,
each part folds its own, and the first key of a part for every status that it could begin with. What it does begin with is
known from the parts before, of which the driver sees a row each. So a key that holds a third of all events is folded in many parts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lineage import shared

# The states of a shard, and which may follow which; "" is a shard that is not there yet.
STATES = ["", "PLANNED", "VALIDATED", "UPLOADING", "REMOTE_VERIFIED", "COMPLETE", "FAILED"]
LEGAL = {
    "": ["PLANNED", "VALIDATED"],
    "PLANNED": ["VALIDATED", "FAILED"],
    "VALIDATED": ["VALIDATED", "UPLOADING", "FAILED"],
    "UPLOADING": ["REMOTE_VERIFIED", "FAILED"],
    "REMOTE_VERIFIED": ["COMPLETE", "FAILED"],
    "COMPLETE": [],
    "FAILED": ["PLANNED", "VALIDATED", "UPLOADING"],
}
_NEXT = [[STATES.index(b) if b in LEGAL[a] else k for b in STATES] for k, a in enumerate(STATES)]

EVENT = "key string, seq long, status string, payload string"
FOLDED = EVENT + ", known string, known_seq long, verdict string"


def _fold(batches):
    """Rows sorted by key, seq, status, with the code of the status and of the key's known one; adds part, whether the row is of the part's first
    key, and for each state before (only the known one, but for the first key) whether the event is applied, and the state after."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    first, last, states = None, None, []
    begun = False
    for batch in batches:
        keys, codes, known, stale = (batch.column(c).to_pylist() for c in ("key", "code", "known_code", "stale"))
        lead, applied, after = [], [], []
        for key, code, before, old in zip(keys, codes, known, stale):
            if not begun or key != last:
                states = list(range(len(STATES))) if not begun else [before]
                first = first if begun else key
                begun, last = True, key
            new = states if old or code is None else [_NEXT[s][code] for s in states]
            takes = [not old and code is not None and STATES[code] in LEGAL[STATES[s]] for s in states]
            states = new
            lead.append(key == first)
            applied.append(takes)
            after.append(list(new))
        columns = [*batch.columns, pa.array([part] * len(keys), pa.int32()), pa.array(lead, pa.bool_()), pa.array(applied, pa.list_(pa.bool_())), pa.array(after, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "lead", "applies", "after"])


def _code(column: str):
    return F.when(F.col(column).isin(STATES[1:]), F.array_position(F.array(*map(F.lit, STATES)), F.col(column)).cast("int") - 1)


def judged(events: DataFrame, state: DataFrame) -> DataFrame:
    """events: EVENT; state: key, status, seq. Returns FOLDED: each event with its verdict, applied, stale or illegal.

    Two shuffles: events meet the state by key, and are sorted by ranges of key and seq. Keys that are null meet nothing."""
    known = state.select(F.col("key"), F.col("status").alias("known"), F.col("seq").alias("known_seq"))
    met = events.select("key", "seq", "status", "payload").distinct().join(known, "key", "left")
    stale = F.col("known").isNotNull() & (F.col("seq").isNull() | F.col("known_seq").isNotNull() & (F.col("seq") <= F.col("known_seq")))
    met = met.withColumn("stale", F.coalesce(stale, F.lit(False)))
    met = met.withColumn("code", F.when(F.col("key").isNotNull(), _code("status"))).withColumn("known_code", F.coalesce(_code("known"), F.lit(0)))
    order = ["key", "seq", "status", "payload"]
    ranged = met.select(*order, "known", "known_seq", "stale", "code", "known_code").repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = f"{EVENT}, known string, known_seq long, stale boolean, code int, known_code int, part int, lead boolean, applies array<boolean>, after array<int>"
    folded = shared(ranged.mapInArrow(_fold, kinds))
    # of each part: its first key, the state that key begins with here if no part before has it, and the states it comes to; its last key and state
    rows = folded.groupBy("part").agg(
        F.min_by(F.struct("key", "known_code"), F.struct(*order)).alias("head"),
        F.max_by(F.struct("key", "after", "lead"), F.struct(*order)).alias("tail"),
    ).collect()
    begins, carried = [], (None, None)
    for r in sorted(rows, key=lambda r: r["part"]):
        start = carried[1] if carried[0] == r["head"]["key"] and carried[1] is not None else r["head"]["known_code"]
        begins.append((r["part"], start))
        carried = (r["tail"]["key"], r["tail"]["after"][start if r["tail"]["lead"] else 0])
    spark = events.sparkSession
    start = spark.createDataFrame(begins, "part int, start int")  # a row for each part
    out = folded.join(F.broadcast(start), "part", "left")
    applies = F.element_at("applies", F.when(F.col("lead"), F.col("start") + 1).otherwise(1))
    verdict = F.when(F.col("stale"), "stale").when(applies, "applied").otherwise("illegal")
    return out.select("key", "seq", "status", "payload", "known", "known_seq", verdict.alias("verdict"))


@dataclass
class Upsert:
    version: int | None  #: of the commit; None where no event was applied, and nothing written
    judged: DataFrame  #: FOLDED


class Registry:
    """A log in a folder that Spark can write."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        where = self._at(self.path)
        if not self._fs.exists(where):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(where)]
        return sorted(int(n[2:]) for n in names if n.startswith("v="))

    def log(self, upto: int | None = None) -> DataFrame:
        """All applied events, with the version of their commit."""
        versions = [v for v in self.versions() if upto is None or v <= upto]
        if not versions:
            return self.spark.createDataFrame([], EVENT + ", version long")
        return self.spark.read.schema(EVENT + ", version long").parquet(*[f"{self.path}/v={v:010d}" for v in versions])

    def state(self, upto: int | None = None) -> DataFrame:
        """key, status, seq, payload of each key's last event, and how many were applied. Combined before the shuffle, so a hot key is a few rows of it."""
        last = F.max_by(F.struct("status", "seq", "payload"), F.struct("version", F.coalesce("seq", F.lit(-(1 << 63))), "status", "payload"))
        return self.log(upto).groupBy("key").agg(last.alias("last"), F.count("*").alias("applied")).select("key", "last.*", "applied")

    def upsert(self, events: DataFrame, tries: int = 5) -> Upsert:
        """Applies events: EVENT, payload may be missing. Writes one commit, or none if nothing is applied."""
        if "payload" not in events.columns:
            events = events.withColumn("payload", F.lit(None).cast("string"))
        events = events.select(F.col("key").cast("string"), F.col("seq").cast("long"), F.col("status").cast("string"), F.col("payload").cast("string"))
        for _ in range(tries):
            version = max(self.versions(), default=0) + 1
            found = shared(judged(events, self.state(version - 1)))
            applied = found.where("verdict = 'applied'").select("key", "seq", "status", "payload", F.lit(version).cast("long").alias("version"))
            if applied.isEmpty():
                return Upsert(None, found)
            if self._commit(applied, version):
                return Upsert(version, found)
        raise RuntimeError(f"{tries} other commits came first, or a writer died: {self.path}/_lock-{max(self.versions(), default=0) + 1:010d}")

    def _commit(self, rows: DataFrame, version: int) -> bool:
        """Whether the version was still free. The table is whole before it has its name."""
        draft = f"{self.path}/_draft-{uuid.uuid4().hex}"
        rows.write.parquet(draft)
        target = self._at(f"{self.path}/v={version:010d}")
        lock = self._at(f"{self.path}/_lock-{version:010d}")
        try:
            # creating a file that must not exist is atomic where renaming a folder is not
            self._fs.create(lock, False).close()
        except Exception as error:
            self._fs.delete(self._at(draft), True)
            if self._fs.exists(lock):
                return False
            raise error
        return self._fs.rename(self._at(draft), target)


def progress(shards: DataFrame, target: int) -> DataFrame:
    """shards: status, tokens. One row: tokens of shards that were acquired, validated, uploaded and verified, what remains of the target and the
    percentage that is verified, and how many shards failed or are pending."""
    reached = {"acquired": STATES[1:], "validated": STATES[2:6], "uploaded": STATES[3:6], "verified": STATES[4:6]}
    total = lambda names: F.coalesce(F.sum(F.when(F.col("status").isin(names), F.col("tokens"))), F.lit(0)).cast("long")
    sums = shards.agg(
        *[total(names).alias(f"{k}_tokens") for k, names in reached.items()],
        F.count_if(F.col("status") == "FAILED").alias("failed_shards"),
        F.count_if(~F.col("status").isin("COMPLETE", "FAILED")).alias("pending_shards"),
    )
    left = F.greatest(F.lit(target) - F.col("verified_tokens"), F.lit(0)).cast("long")
    return sums.select(F.lit(target).cast("long").alias("target_tokens"), "*", left.alias("remaining_tokens"), (F.col("verified_tokens") / F.lit(target) * 100).alias("percentage_complete"))
