"""The guard between training rows and evaluation cases: a Bloom filter in the scan, exact joins on what it leaves.

The keys of one side, ids, contents and questions each under its own name, set bits in a filter that is built by an aggregate:
tasks combine their bits before the shuffle, and the filter is one row of a fixed number of words, whatever the number of keys.
The other side, however large, is tried against it where it is read, so that only rows that may overlap are shuffled. A filter has no false
negatives; more keys than it is made for only let more rows through to the exact joins.

A null id, content or question equals nothing. Of several reasons a row has the first: id, content, question.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .similarity import eval_overlap


class TrainOverlap(ValueError):
    """Training rows are among the evaluation cases."""


@dataclass(frozen=True)
class BloomConfig:
    words: int = 1 << 14  #: of 64 bits: about a percent of false positives up to 100,000 keys
    hashes: int = 7


def _places(key: Column, config: BloomConfig) -> list[Column]:
    """Bits of a key: a double hash, whose second part is odd."""
    a, b = F.xxhash64(key, F.lit(1)), F.xxhash64(key, F.lit(2)).bitwiseOR(F.lit(1))
    bits = 64 * config.words
    # both parts are cut first, so that no product overflows
    return [F.pmod(F.pmod(a, F.lit(bits)) + k * F.pmod(b, F.lit(bits)), F.lit(bits)) for k in range(config.hashes)]


def bloom(keys: DataFrame, config: BloomConfig = BloomConfig()) -> DataFrame:
    """keys: column key. One row, with the column bloom: an array of config.words numbers."""
    place = keys.where("key is not null").select(F.explode(F.array(*_places(F.col("key"), config))).alias("place"))
    word = F.shiftright("place", 6).cast("int").alias("word")
    bits = place.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("bits"))
    every = keys.sparkSession.range(config.words).select(F.col("id").cast("int").alias("word")).join(bits, "word", "left")
    return every.agg(F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits"))))["bits"].alias("bloom"))


def may_hold(filter_: Column, key: Column, config: BloomConfig = BloomConfig()) -> Column:
    """Whether a key may be among the filter's; false for null."""
    found = F.lit(True)
    for place in _places(key, config):
        word = F.get(filter_, F.shiftright(place, 6).cast("int"))
        found &= F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1
    return F.coalesce(key.isNotNull() & found, F.lit(False))


def _keys(rows: DataFrame) -> DataFrame:
    named = F.array(F.concat(F.lit("id:"), F.col("id").cast("string")), F.concat(F.lit("content:"), "content"))
    asked = F.coalesce(F.transform("questions", lambda q: F.concat(F.lit("question:"), q)), F.array().cast("array<string>"))
    return rows.select(F.explode(F.concat(named, asked)).alias("key"))


def overlap(train: DataFrame, cases: DataFrame, config: BloomConfig = BloomConfig()) -> DataFrame:
    """id, reason of each training row that a case equals. Both: id, content (a hash), questions (an array)."""
    found = bloom(_keys(cases), config)
    id_, content = F.concat(F.lit("id:"), F.col("id").cast("string")), F.concat(F.lit("content:"), "content")
    asked = F.exists("questions", lambda q: may_hold(F.col("bloom"), F.concat(F.lit("question:"), q), config))
    hit = may_hold(F.col("bloom"), id_, config) | may_hold(F.col("bloom"), content, config) | F.coalesce(asked, F.lit(False))
    some = train.withColumn("id", F.col("id").cast("string")).crossJoin(F.broadcast(found)).where(hit).select("id", "content", "questions")  # one row of fixed size
    return eval_overlap(some, cases)


def keep_apart(train: DataFrame, cases: DataFrame, config: BloomConfig = BloomConfig()) -> None:
    """Raises TrainOverlap, with the number of rows and some of them, if a training row is among the cases."""
    found = overlap(train, cases, config)
    n = found.count()
    if n:
        some = ", ".join(f"{r['id']} ({r['reason']})" for r in found.orderBy("id").limit(5).collect())
        raise TrainOverlap(f"{n} training rows are among the cases: {some}{', ...' if n > 5 else ''}")
