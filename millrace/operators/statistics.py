"""What a set of records is like: counts, lengths, quality, languages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as T
from . import formats, quality, validation

#: Size of the sketch that keeps a group's lengths, and by what share of all ranks its median may be off; sketches of this size stay below half of it in 99 of 100 cases.
SKETCH, RANK_ERROR = 1024, 0.01


def conversation(df: DataFrame) -> tuple[Column, Column]:
    """What the user says and what the assistant says, from the messages where there are any, else from input and expected_output."""
    of = lambda c: F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("")
    asked, told = of("input"), of("expected_output")
    if "messages" not in df.columns:
        return asked, told
    user, assistant = quality.flatten("messages")
    some = F.coalesce(F.size("messages"), F.lit(0)) > 0
    return F.when(some, user).otherwise(asked), F.when(some, assistant).otherwise(told)


def whole(df: DataFrame) -> Column:
    return F.concat_ws("\n", *conversation(df))


def declared_language(df: DataFrame) -> Column:
    """What the source says of a record's language, or null."""
    fields = {f.name: f.dataType for f in df.schema}
    named = "metadata" in fields and "language" in getattr(fields["metadata"], "names", [])
    return F.col("metadata.language") if named else F.lit(None).cast("string")


def turns(df: DataFrame) -> Column:
    return formats.sft_messages(F.col("messages") if "messages" in df.columns else None, df.columns)


def upper_median(lengths: DataFrame) -> DataFrame:
    """Of a column n: the value in the middle, of two the greater. From counts of values, summed within ranges of them, so no task sees all."""
    counts = lengths.groupBy("n").agg(F.count("*").alias("c")).withColumn("part", F.floor(F.col("n") / 4096))
    parts = counts.groupBy("part").agg(F.sum("c").alias("c"))
    before = parts.select("part", (F.sum("c").over(W.orderBy("part")) - F.col("c")).alias("before"))  # a row for each 4096 lengths
    total = parts.agg(F.sum("c").alias("all"))
    run = counts.join(F.broadcast(before), "part").withColumn("upto", F.col("before") + F.sum("c").over(W.partitionBy("part").orderBy("n"))).crossJoin(total)  # one row
    return run.where("upto >= floor(all / 2) + 1").agg(F.min("n").alias("upper_median"))


def quality_statistics(df: DataFrame) -> dict:
    """Rows, languages found, share of Vietnamese, and characters of the conversations."""
    user, assistant = conversation(df)
    rows = df.select(T.detect_language(T.prose(F.concat_ws("\n", user, assistant))).alias("language"), (F.length(user) + F.length(assistant)).cast("long").alias("n"))
    found = {r.language: r for r in rows.groupBy("language").agg(F.count("*").alias("rows"), F.sum("n").alias("chars"), F.max("n").alias("longest")).collect()}  # five at most
    n = sum(r.rows for r in found.values())
    median = upper_median(rows).first()[0]
    return {
        "examples": n,
        "languages": {k: found[k].rows for k in sorted(found)},
        "vietnamese_share": round(found["vi"].rows / n, 4) if "vi" in found else 0.0,
        "characters": {"mean": round(sum(r.chars for r in found.values()) / n, 1) if n else 0, "median": median or 0, "max": max((r.longest for r in found.values()), default=0)},
    }


def statistics(df: DataFrame, duplicates: int = 0, rejected: int = 0) -> dict:
    """Rows, domains, sources, characters of the records as JSON, mean quality, and the shares of duplicates and rejected rows."""
    size, score = validation.ascii_length(validation.canonical_json(df)), F.col("quality_score") if "quality_score" in df.columns else F.lit(None).cast("double")
    r = df.agg(F.count("*").alias("n"), F.sum(size).alias("total"), F.max(size).alias("longest"), F.avg(score).alias("quality"), F.count(score).alias("scored")).first()
    counts = lambda c: {k: n for k, n in sorted(tuple(x) for x in df.groupBy(c).count().collect())}  # noqa: E731  a row for each domain or source
    share = lambda k: k / (r.n + k) if r.n or k else 0
    return {
        "examples": r.n,
        "domains": counts(F.col("domain")),
        "sources": counts(F.col("source")["name"]),
        "characters": {"total": r.total or 0, "mean": round(r.total / r.n, 2) if r.n else 0, "max": r.longest or 0},
        "quality": {"mean": round(r.quality, 2) if r.scored else 0, "scored": r.scored},
        "duplicate_rate": share(duplicates),
        "validation_failure_rate": share(rejected),
    }


def summary(df: DataFrame, *by: str, length: Column, score: Column | None = None) -> DataFrame:
    """A row for each group of by: examples, characters, longest, scored, quality_total and a sketch of the lengths.

    Such rows add up (merge()), so statistics of several builds need their summaries only, however large the builds are. A
    row whose length is null is an example without characters; scores are kept to six decimals, as decimals, so that
    sums do not depend on their order. The sketch has a bounded size; with fewer than SKETCH lengths it holds all of them.
    """
    n, points = length.cast("bigint"), (F.lit(None) if score is None else score).cast("decimal(12,6)")
    return df.select(*by, n.alias("_n"), points.alias("_q")).groupBy(*by).agg(
        F.count("*").alias("examples"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("characters"),
        F.max("_n").alias("longest"),
        F.count("_q").alias("scored"),
        F.coalesce(F.sum("_q"), F.lit(0)).cast("decimal(28,6)").alias("quality_total"),
        F.kll_sketch_agg_bigint("_n", SKETCH).alias("lengths"),
    )


def merge(summaries: DataFrame, *by: str) -> DataFrame:
    """Summaries of the same groups as one, also after some of the groups' columns were left out of by."""
    total = lambda c, kind: F.sum(c).cast(kind).alias(c)
    return summaries.groupBy(*by).agg(
        total("examples", "bigint"), total("characters", "bigint"), F.max("longest").alias("longest"), total("scored", "bigint"), total("quality_total", "decimal(28,6)"), F.kll_merge_agg_bigint("lengths", SKETCH).alias("lengths")
    )


def told(summaries: DataFrame) -> DataFrame:
    """Summaries with mean, median and quality in place of what they are made of. The median is within RANK_ERROR of the middle; groups without a length have nulls."""
    some = F.col("longest").isNotNull()
    shown = summaries.withColumns({
        "mean": F.when(some, F.col("characters").cast("double") / F.kll_sketch_get_n_bigint("lengths")),
        "median": F.when(some, F.kll_sketch_get_quantile_bigint("lengths", F.lit(0.5))),
        "quality": F.when(F.col("scored") > 0, F.col("quality_total").cast("double") / F.col("scored")),
    })
    return shown.drop("lengths", "quality_total")


def record(summaries: DataFrame, folder: str, build: str) -> None:
    """Keeps the summary of a build in a folder of all builds; a build that is done again replaces its own."""
    summaries.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/build={build}")


def recorded(spark: SparkSession, folder: str, *by: str, builds: tuple[str, ...] = ()) -> DataFrame:
    """The summaries of all builds of a folder, or of those that are named, as one. Only summaries are read."""
    rows = spark.read.option("basePath", folder).schema(spark.read.parquet(folder).drop("build").schema).parquet(*[f"{folder.rstrip('/')}/build={b}" for b in builds] or [folder])
    return merge(rows, *by)
