"""The build of a dataset: validate, dedup, filter, keep apart from the evaluation set, score, mix, export, with a manifest.

Every row of the input ends in exactly one place: train, or rejected with the reason. Steps are columns of one table:
each step adds what it holds against a row that no step before has held anything against.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import formats, mixing, quality, scoring, similarity, validation
from ..operators import statistics as S
from ..operators.dedup import exact_dedup
from ..operators.lineage import shared
from ..sources.writers import write_jsonl, write_manifest

FILTERS = ("language", "length", "repetition")
PARTS = ("question", "conversation")


class EvalOverlap(ValueError):
    """Training rows equal evaluation rows."""


def content_hash(df: DataFrame) -> Column:
    """Digest of what a record says; null and missing are the empty text."""
    return F.sha2(validation.canonical_json(df), 256)


def questions(df: DataFrame) -> Column:
    """What is asked, in the form in which questions are compared: input, prompt and every turn of a user."""
    asked = [F.array(F.col(c)) for c in ("input", "prompt") if c in df.columns]
    if "messages" in df.columns:
        user = F.transform(F.filter("messages", lambda m: m["role"] == F.lit("user")), lambda m: m["content"])
        asked.append(F.coalesce(user, F.array().cast("array<string>")))
    plain = F.transform(F.concat(*asked), lambda q: T.strip(T.normalize(q), " .?!"))
    return F.array_distinct(F.filter(plain, lambda q: q != ""))


def quality_reasons(df: DataFrame, config: quality.QualityConfig) -> dict[str, Column]:
    """Of each filter that is on, why a row goes, or null."""
    user, assistant = S.conversation(df)
    every = {
        "language": lambda: quality.language_reason(T.prose(F.concat_ws("\n", user, assistant)), S.declared_language(df), config),
        "length": lambda: quality.length_reason(user, assistant, config),
        "repetition": lambda: quality.first_turn_reason(S.turns(df), config),
    }
    return {name: every[name]() for name in FILTERS if getattr(config, name)}


def annotate(records: DataFrame, config: quality.QualityConfig | None = None, position: str | None = None) -> DataFrame:
    """records with errors, duplicate_of, quality_filter and quality_reason: what validation, exact dedup and the filters of single rows hold against a row, null or empty for nothing.

    Of rows that share an id, the first by position stays sound; without a column for it, by their place in the frame.
    """
    if position is None:
        placed = shared(records.withColumn("_place", F.monotonically_increasing_id()))  # as a table, so that places do not change
        return annotate(placed, config, "_place").drop("_place")
    df = records.withColumn("errors", validation.errors(records))
    df = validation.with_duplicate_ids(df, "id", position)
    good = exact_dedup(df.where(F.size("errors") == 0).withColumn("_hash", content_hash(df)), "id", "_hash").drop("_hash")
    reasons = quality_reasons(good, config) if config else {}
    told = F.coalesce(*[F.when(r.isNotNull(), F.struct(F.lit(name).alias("filter"), r.alias("reason"))) for name, r in reasons.items()]) if reasons else F.lit(None).cast("struct<filter:string,reason:string>")
    good = good.withColumn("_told", F.when(F.col("duplicate_of").isNull(), told))
    good = good.withColumn("quality_filter", F.col("_told.filter")).withColumn("quality_reason", F.col("_told.reason")).drop("_told")
    return good.unionByName(df.where(F.size("errors") > 0), allowMissingColumns=True)


def near_duplicates(df: DataFrame, config: quality.QualityConfig) -> DataFrame:
    """id, partner: rows that go for an earlier one that stays. Rows of the same words are compared as one, by the first of them; rows without words are alike."""
    every = shared(similarity.classes(df, "id", S.whole(df)))
    first = df.join(every.where("id = rep").select("id"), "id", "left_semi")
    gone = similarity.near_first(similarity.shingle_sets(first, "id", S.whole(first), config.shingle_words), config.threshold).withColumnRenamed("id", "rep")
    return every.join(gone, "rep", "left").where("partner is not null or id <> rep").select("id", F.coalesce("partner", "rep").alias("partner"))


def near_evaluation(df: DataFrame, evaluation: DataFrame, config: quality.QualityConfig) -> DataFrame:
    """id, eval_id, part, similarity: rows that are near an evaluation row in what is asked, or in the whole conversation; of several the nearest, of parts the first."""

    def parts(rows):
        if "prompt" in rows.columns and "input" not in rows.columns:
            first = [F.nullif(F.col(c), F.lit("")) for c in ("reference", "expected_output", "expected") if c in rows.columns]
            user, assistant = F.coalesce("prompt", F.lit("")), F.coalesce(*first, F.lit(""))
        else:
            user, assistant = S.conversation(rows)
        return dict(zip(PARTS, (user, F.concat_ws("\n", user, assistant))))

    mine, theirs, found = parts(df), parts(evaluation), None
    for rank, part in enumerate(PARTS):
        sets = lambda rows, text: similarity.shingle_sets(rows, "id", text, config.shingle_words)
        pairs = similarity.similar_pairs(sets(df, mine[part]), sets(evaluation, theirs[part]), config.threshold)
        rows = pairs.select(F.col("a").alias("id"), F.struct(F.lit(-rank).alias("rank"), (F.col("common") / F.col("joined")).alias("similarity"), F.col("b").alias("eval_id")).alias("m"))
        found = rows if found is None else found.union(rows)
    best = found.groupBy("id").agg(F.max("m").alias("m"))
    return best.select("id", "m.eval_id", F.element_at(F.array(*map(F.lit, PARTS)), 1 - F.col("m.rank")).alias("part"), F.round("m.similarity", 3).alias("similarity"))


def build(records: DataFrame, output: str, version: str, evaluation: DataFrame | None = None, config: quality.QualityConfig | None = None, weights: dict[str, float] | None = None, kinds: tuple[str, ...] = ("sft",), seed: int = 0, sources: tuple[str, ...] = (), eval_sources: tuple[str, ...] = ()) -> dict:
    """Writes raw, train, rejected and each format to folders of output and returns the manifest.

    Exact overlap with the evaluation set raises EvalOverlap; rows near it go to rejected. Rejected rows come by what
    rejected them, exact duplicates last.
    """
    df = shared(annotate(records, config))
    valid = F.size("errors") == 0
    unique = df.where(valid & F.col("duplicate_of").isNull())
    fine = unique.where("quality_filter is null")
    gone = shared(near_duplicates(fine, config)) if config and config.near_duplicate else None
    kept = fine.join(gone.select("id"), "id", "left_anti") if gone is not None else fine
    kept, near = shared(kept), None
    if evaluation is not None:
        ask = lambda rows: rows.select("id", content_hash(rows).alias("content"), questions(rows).alias("questions"))
        if found := similarity.eval_overlap(ask(kept), ask(evaluation)).orderBy("id").limit(5).collect():
            raise EvalOverlap(f"rows of the evaluation set are in the training set: {[tuple(r) for r in found]}")
        near = shared(near_evaluation(kept, evaluation, config or quality.QualityConfig()))
    train = kept.join(near.select("id"), "id", "left_anti") if near is not None else kept
    has = lambda c, field: F.col(c)[field] if c in train.columns and field in getattr(train.schema[c].dataType, "names", []) else F.lit(None)
    reasoned = F.lit(False)
    for c in ("reasoning", "trajectory"):
        if c in train.columns:
            reasoned |= F.col(c).isNotNull() & ((F.col(c) != "") if train.schema[c].dataType.typeName() == "string" else F.size(c) > 0)
    score = scoring.record_score(F.lit(True), has("verification", "passed").cast("boolean"), reasoned, F.coalesce(has("source", "url").cast("string"), F.lit("")) != "")
    train = train.withColumn("quality_score", score).withColumn("validation_status", F.lit("valid"))
    if weights:
        train = mixing.shuffled(mixing.sample(train, "domain", "id", weights, seed), "id", seed)
    train = shared(train.drop("errors", "duplicate_of", "quality_filter", "quality_reason"))
    out = [df.where(~valid), unique.where("quality_filter is not null")]
    if gone is not None:
        out.append(fine.join(gone, "id").withColumn("quality_filter", F.lit("near_duplicate")).withColumn("quality_reason", F.concat(F.lit("near duplicate of "), F.col("partner").cast("string"))).drop("partner"))
    if near is not None:
        why = F.concat(F.lit("near evaluation row "), F.col("eval_id").cast("string"), F.lit(" in the "), "part")
        out.append(kept.join(near, "id").withColumn("quality_filter", F.lit("eval_near_duplicate")).withColumn("quality_reason", why).drop("eval_id", "part", "similarity"))
    duplicates = df.where(valid & F.col("duplicate_of").isNotNull())
    rejected = None
    for rank, rows in enumerate([*out, duplicates]):
        rows = rows.withColumn("_rank", F.lit(rank)).withColumn("validation_status", F.lit("rejected"))
        rejected = rows if rejected is None else rejected.unionByName(rows, allowMissingColumns=True)
    rejected = shared(rejected)
    write_jsonl(records, f"{output}/raw")
    write_jsonl(train, f"{output}/train")
    write_jsonl(rejected.orderBy("_rank", "id").drop("_rank"), f"{output}/rejected")
    for kind in kinds:
        write_jsonl(formats.prepare(train, kind), f"{output}/{kind}")
    by_rank = dict(tuple(r) for r in rejected.groupBy(F.coalesce("quality_filter", F.when(F.col("duplicate_of").isNotNull(), "duplicate").otherwise("validation"))).count().collect())
    report = {"enabled": False}
    if config:
        report = {"enabled": True, "config": asdict(config), "before": S.quality_statistics(unique), "after": S.quality_statistics(kept), "removed": {name: by_rank.get(name, 0) for name in (*FILTERS, "near_duplicate")}}
    eval_report = None
    if near is not None:
        examples = [r.asDict() for r in near.orderBy("id").limit(10).collect()]
        eval_report = {"removed": by_rank.get("eval_near_duplicate", 0), "eval_records": evaluation.count(), "threshold": (config or quality.QualityConfig()).threshold, "parts": list(PARTS), "examples": examples}
    told = sum(by_rank.values())
    manifest = {"version": version, "seed": seed, "sources": list(sources), "eval_sources": list(eval_sources), "statistics": S.statistics(train, by_rank.get("duplicate", 0), told - by_rank.get("duplicate", 0)), "quality": report, "eval_near_duplicate": eval_report, "rejected": told}
    return write_manifest(train, manifest, f"{output}/manifest")
