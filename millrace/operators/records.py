"""From rows of any source to records: ids, messages, questions and answers, and what they say about themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, MapType, StructType

from ..functions import text as T
from ..sources.readers import SourceSpec
from .mixing import with_position

# Other names of roles, and texts that are no ids.
ROLE_ALIASES = {"human": "user", "gpt": "assistant"}
NO_IDS = ("nan", "none", "null")
MESSAGE = "struct<role:string,content:string>"


def role(c: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in ROLE_ALIASES.items() for x in pair]), c), c)


def clean_messages(messages: Column, kind: ArrayType) -> Column:
    """Turns as role and content, also of the fields from and value. A turn that is no structure is kept with nulls, so that validation rejects its record."""
    inner = kind.elementType
    names = set(inner.names) if isinstance(inner, StructType) else None

    def field(m, *options):
        found = [m[o] for o in options if names is None or o in names]
        return F.coalesce(*found, F.lit(None).cast("string")).cast("string") if found else F.lit(None).cast("string")

    if names is None and not isinstance(inner, MapType):
        turn = lambda m: F.struct(F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("content"))
    else:
        turn = lambda m: F.struct(role(field(m, "role", "from")).alias("role"), field(m, "content", "value").alias("content"))
    return F.transform(messages, turn).cast(f"array<{MESSAGE}>")


def prompt_answer(messages: Column) -> tuple[Column, Column]:
    """The first turn of a user, and the last turn."""
    return F.try_element_at(F.filter(messages, lambda m: m["role"] == F.lit("user")), F.lit(1))["content"], F.try_element_at(messages, F.lit(-1))["content"]


def identifier(c: Column, kind, position: Column) -> Column:
    """The id as text, or the row's position where it is null, empty, not a number, or a text that stands for none."""
    text = c.cast("string")
    absent = text.isNull() | (text == "") | F.lower(F.trim(text)).isin(*NO_IDS)
    if isinstance(kind, (FloatType, DoubleType)):
        absent |= F.isnan(c)
    return F.when(absent, position.cast("string")).otherwise(text)


def map_rows(df: DataFrame, spec: SourceSpec, version: str, order: str) -> DataFrame:
    """Rows of a source as records; `order` is a column whose order is that of the rows, unique in the source. What is wrong with a row is left to validation."""
    kinds = {f.name: f.dataType for f in df.schema}
    placed = with_position(df, order)
    if spec.messages_field:
        messages = clean_messages(F.col(spec.messages_field), kinds[spec.messages_field])
        prompt, answer = prompt_answer(messages)
    else:
        messages, prompt, answer = None, F.col(spec.mapping["input"]), F.col(spec.mapping["expected_output"])
    own = spec.mapping.get("id")
    told = identifier(F.col(own), kinds[own], F.col("position")) if own else F.col("position").cast("string")
    out = [
        F.concat(T.slug(F.lit(spec.name)), F.lit("-"), told).alias("id"),
        F.lit(spec.domain).alias("domain"),
        F.lit(spec.task).alias("task"),
        prompt.cast("string").alias("input"),
        answer.cast("string").alias("expected_output"),
        F.struct(F.lit(spec.name).alias("name"), F.lit(spec.url).alias("url"), F.lit(spec.revision).alias("revision")).alias("source"),
        F.struct(F.lit(spec.license).alias("name")).alias("license"),
        F.lit(version).alias("dataset_version"),
        F.struct(F.lit(spec.split).alias("split"), F.col("position").alias("row"), F.lit(spec.language).cast("string").alias("language")).alias("metadata"),
    ]
    out += [messages.alias("messages")] if messages is not None else []
    out += [F.nullif(F.col(spec.mapping[c]).cast("string"), F.lit("")).alias(c) for c in ("context", "reasoning") if spec.mapping.get(c)]
    return placed.select(*out)


def valid_trajectory(steps: Column) -> Column:
    """Every step names a tool; arguments that are missing are no arguments."""
    return F.coalesce(F.forall(steps, lambda s: s["tool"].isNotNull()), F.lit(False))


# What a source of a corpus has to say.
SOURCE_FIELDS = "name url license license_url domain language revision format size_bytes tokens sha256 contact".split()


def absent(df: DataFrame, fields: list[str] = SOURCE_FIELDS) -> Column:
    """Names of the fields that are null, empty, or no column at all."""
    empty = lambda c: F.col(c).isNull() | (F.col(c).cast("string") == "") if c in df.columns else F.lit(True)
    return F.array_compact(F.array(*[F.when(empty(c), F.lit(c)) for c in fields]))
