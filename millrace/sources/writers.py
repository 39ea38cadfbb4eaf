"""Sinks: JSON Lines with sorted keys at every depth and nulls kept, one folder per output, and a manifest of one row.

The bytes of a line are those of Python's json.dumps with sort_keys and ensure_ascii=False, but for numbers that are not whole, which are as Spark
prints them. A checksum is over parts in order: rows are sorted by key and cut into parts by ranges of it, each part has a digest of its
lines, and the digests in order have one. So it changes when two rows swap a field, and does not depend on how rows were dealt.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def sorted_keys(column: Column, kind: DataType) -> Column:
    """A value whose structs have their fields in order of name, at every depth; maps become sorted too."""
    if isinstance(kind, StructType):
        fields = [sorted_keys(column[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(column.isNotNull(), F.struct(*fields)) if fields else column
    if isinstance(kind, ArrayType):
        return F.transform(column, lambda x: sorted_keys(x, kind.elementType))
    if isinstance(kind, MapType):
        entries = F.array_sort(F.map_entries(F.transform_values(column, lambda _, v: sorted_keys(v, kind.valueType))), lambda x, y: F.when(x["key"] < y["key"], -1).when(x["key"] > y["key"], 1).otherwise(0))
        return F.map_from_entries(entries)
    return column


def _spaced(line: Column) -> Column:
    """The separators that json.dumps has: a blank after each colon and comma outside of strings. Strings are taken whole by the pattern."""
    return F.array_join(F.transform(F.regexp_extract_all(line, F.lit(_TOKEN), F.lit(0)), lambda t: F.when(t.isin(",", ":"), F.concat(t, F.lit(" "))).otherwise(t)), "")


#: A string, one of the signs between values, or a run of anything else.
_TOKEN = r'"(?:[^"\\]|\\.)*+"|[,:]|[^",:]+'


def json_lines(df: DataFrame) -> Column:
    """Each row as a line: keys sorted at every depth, nulls written."""
    row = F.struct(*[sorted_keys(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in sorted(df.schema.fields, key=lambda f: f.name)])
    return _spaced(F.to_json(row, {"ignoreNullFields": "false"}))


def write_jsonl(df: DataFrame, path: str) -> None:
    df.select(json_lines(df).alias("value")).write.mode("overwrite").text(path)


#: Rows of a part of a checksum, about: the lines' digests of a part are held together once.
PART_ROWS = 100_000


def part_digests(df: DataFrame, key: str = "id") -> DataFrame:
    """part, rows, digest: SHA-256 over the digests of a part's lines in order of key, then of line. Parts are ranges of the key's hash, so they are even whatever the key is."""
    parts = max(1, -(-df.count() // PART_ROWS))
    place = F.xxhash64(F.col(key).cast("string"))
    part = F.least(F.floor((place.cast("double") / 2.0**64 + 0.5) * parts), F.lit(parts - 1)).cast("int")
    rows = df.select(part.alias("part"), F.col(key).cast("string").alias("key"), F.sha2(json_lines(df), 256).alias("line"))
    ordered = F.array_sort(F.collect_list(F.struct("key", "line")))
    return rows.groupBy("part").agg(F.count("*").alias("rows"), ordered.alias("lines")).select("part", "rows", F.sha2(F.array_join(F.transform("lines", lambda x: x["line"]), ""), 256).alias("digest"))


def checksum(df: DataFrame, key: str = "id") -> str:
    """SHA-256 over the digests of all parts in order; what comes to the driver is a digest for each PART_ROWS rows."""
    digests = [r["digest"] for r in part_digests(df, key).orderBy("part").collect()]
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def write_manifest(df: DataFrame, manifest: dict, path: str, key: str = "id") -> dict:
    manifest = {**manifest, "checksum": checksum(df, key), "examples": df.count()}
    df.sparkSession.createDataFrame([(json.dumps(manifest, sort_keys=True, indent=2),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return manifest


def write_shards(df: DataFrame, path: str, by: str = "domain") -> None:
    df.write.mode("overwrite").partitionBy(by).json(path)
