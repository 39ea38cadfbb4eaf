"""Validation of records: error codes, an empty array for a valid one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The vocabularies of a record.
REQUIRED = "id domain task input expected_output source license dataset_version".split()
DOMAINS = "coding software_engineering math_logic reasoning planning tool_use agent research trading debugging chat".split()
STATUSES = "pending valid rejected".split()
ROLES = "system user assistant".split()
MAX_CHARS = 100_000


#: What a record says, in order of name.
CONTENT = "context domain expected_output input messages reasoning task trajectory".split()


def canonical_json(df: DataFrame) -> Column:
    """What a record says as JSON without spaces and with sorted keys; null and missing fields are the empty text."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema}

    def part(c):
        if c not in kinds:
            return F.lit('""')
        if c == "messages":
            told = F.to_json(F.transform(c, lambda m: F.struct(m["content"].alias("content"), m["role"].alias("role"))), {"ignoreNullFields": "false"})
        elif kinds[c] in ("array", "struct", "map"):
            told = F.to_json(c)
        else:  # a text is quoted as the only field of an object
            told = F.regexp_extract(F.to_json(F.struct(F.col(c).cast("string").alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
        return F.when(F.col(c).isNull(), F.lit('""')).otherwise(told)

    fields = [x for c in CONTENT for x in (F.lit(f'"{c}":'), part(c), F.lit(","))][:-1]
    return F.concat(F.lit("{"), *fields, F.lit("}"))


def ascii_length(json: Column) -> Column:
    """Characters of a JSON text in which others than ASCII are escaped, those beyond 16 bits as two."""
    return F.length(json) + 5 * F.regexp_count(json, F.lit(r"[^\x00-\x7F]")) + 6 * F.regexp_count(json, F.lit(r"[\x{10000}-\x{10FFFF}]"))


def missing(row_type: dict[str, str]) -> Column:
    """Codes of required fields that are null or empty; row_type maps columns to their type names."""
    empty = lambda c: F.col(c).isNull() | ((F.col(c) == "") if row_type.get(c) == "string" else F.lit(False))
    return F.array_compact(F.array(*[F.when(empty(c), F.lit(f"missing:{c}")) for c in REQUIRED]))


def valid_messages(m: Column) -> Column:
    """Not empty, every role known, every content with text, a user's turn among them, and the assistant's last."""
    sound = F.forall(m, lambda x: x["role"].isNotNull() & x["role"].isin(ROLES) & x["content"].isNotNull() & F.coalesce(x["content"].rlike(r"[^\s\p{Z}]"), F.lit(False)))
    return F.coalesce((F.size(m) > 0) & sound & F.exists(m, lambda x: x["role"] == F.lit("user")) & (F.element_at(m, -1)["role"] == "assistant"), F.lit(False))


def errors(df: DataFrame, max_chars: int | None = MAX_CHARS) -> Column:
    """All codes of a record; where a field is missing, the missing codes alone. Columns that df lacks, and nulls in them, have their defaults. Sizes are not looked at where max_chars is None."""
    have, kinds = set(df.columns), {f.name: f.dataType.typeName() for f in df.schema}
    named = lambda c: F.coalesce(F.col(c)["name"], F.lit("")) == "" if kinds.get(c) in ("struct", "map") else F.lit(True)
    checks = [
        F.when(named("source"), "invalid:source"),
        F.when(named("license"), "invalid:license"),
        F.when(~F.col("domain").isin(DOMAINS), "invalid:domain"),
    ]
    if "validation_status" in have:
        checks.append(F.when(~F.coalesce("validation_status", F.lit("pending")).isin(STATUSES), "invalid:validation_status"))
    if "difficulty" in have:
        whole = kinds["difficulty"] in ("byte", "short", "integer", "long")
        checks.append(F.when(~F.coalesce(F.col("difficulty"), F.lit(1)).between(1, 5) if whole else F.col("difficulty").isNotNull(), "invalid:difficulty"))
    if "quality_score" in have:
        checks.append(F.when(F.col("quality_score").isNotNull() & ~F.coalesce(F.col("quality_score").cast("double").between(0, 1), F.lit(False)), "invalid:quality_score"))
    if "messages" in have:
        checks.append(F.when(F.col("messages").isNotNull() & ~valid_messages(F.col("messages")), "invalid:messages"))
    if max_chars is not None:
        checks.append(F.when(ascii_length(canonical_json(df)) > max_chars, "invalid:too_large"))
    gone = missing(kinds)
    return F.when(F.size(gone) > 0, gone).otherwise(F.array_compact(F.array(*checks)))


def with_duplicate_ids(df: DataFrame, key: str, position: str, codes: str = "errors") -> DataFrame:
    """Adds duplicate:id to every row that repeats an id of an earlier one; rows with missing fields neither claim nor repeat."""
    counted = ~F.exists(codes, lambda e: e.startswith("missing:"))
    first = df.where(counted).groupBy(key).agg(F.min(position).alias("_first"))
    repeated = counted & (F.col(position) > F.col("_first"))
    return df.join(first, key, "left").withColumn(codes, F.when(repeated, F.array_append(codes, F.lit("duplicate:id"))).otherwise(F.col(codes))).drop("_first")
