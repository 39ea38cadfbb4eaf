"""Training formats of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sft_messages(messages: Column | None = None, have: list[str] | None = None) -> Column:
    """The messages as they are, or a user's and an assistant's turn from input, context, reasoning and expected_output; have lists the columns that there are, if not all four."""
    of = lambda c: F.col(c) if have is None or c in have else F.lit(None).cast("string")
    context, reasoning = F.coalesce(of("context"), F.lit("")), F.coalesce(of("reasoning"), F.lit(""))
    question = F.when(context != "", F.concat(context, F.lit("\n\n"), of("input"))).otherwise(of("input"))
    answer = F.when(reasoning != "", F.concat(F.lit("<think>\n"), reasoning, F.lit("\n</think>\n\n"), of("expected_output"))).otherwise(of("expected_output"))
    built = F.array(F.struct(F.lit("user").alias("role"), question.alias("content")), F.struct(F.lit("assistant").alias("role"), answer.alias("content")))
    return built if messages is None else F.when(F.size(messages) > 0, messages).otherwise(built)


def rejected_output(df: DataFrame) -> Column:
    """The answer that was not preferred: a column of its own, or a field of metadata; empty where there is none."""
    kind = {f.name: f.dataType for f in df.schema}
    found = [F.col("rejected_output")] if "rejected_output" in kind else []
    inside = kind.get("metadata")
    if inside is not None and (inside.typeName() == "map" or "rejected_output" in getattr(inside, "names", [])):
        found.append(F.col("metadata")["rejected_output"].cast("string"))
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in found], F.lit(""))


def prepare(df: DataFrame, kind: str, key: str = "id") -> DataFrame:
    """The rows of df that a format has a use for; columns that df lacks are empty."""
    of = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    if kind == "sft":
        return df.select(key, sft_messages(F.col("messages") if "messages" in df.columns else None, df.columns).alias("messages"))
    if kind == "preference":
        rejected = rejected_output(df)
        return df.where(rejected != "").select(key, of("input").alias("prompt"), of("expected_output").alias("chosen"), rejected.alias("rejected"))
    if kind in ("tool_use", "trajectory"):
        column = {"tool_use": "tools_used", "trajectory": "trajectory"}[kind]
        return df.where(F.size(column) > 0 if column in df.columns else F.lit(False))
    if kind == "reasoning":
        return df.where(F.coalesce(of("reasoning"), F.lit("")) != "")
    raise ValueError(f"no such training format: {kind}")
