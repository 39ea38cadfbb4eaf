"""Queries of the dataset source, the registry's log, its fold as a stream, and evaluation from a cache."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import incremental, registry
from ..operators.lineage import new_folder, shared
from ..sources.plugin import read_dataset
from ..streaming.ordered import ordered_stream
from .registry import Tables, query


@query("SELECT doc_id, source, n_chars FROM documents WHERE lang = 'fr' AND n_chars > 500")
def src_plugin_scan(t: Tables):
    """The whole table through the registered source: lang is compared in the source, n_chars by Spark."""
    rows = read_dataset(t.spark, f"{t.folder}/documents.parquet", where='[["lang", "fr"]]')
    return rows.where(F.col("n_chars") > 500).select("doc_id", "source", "n_chars")


# Which status an order stands for.
ORDER_STATUS = {"1-URGENT": "PLANNED", "2-HIGH": "VALIDATED", "3-MEDIUM": "UPLOADING", "4-NOT SPECIFIED": "REMOTE_VERIFIED", "5-LOW": "FAILED"}
# Which status an event stands for.
EVENT_STATUS = {"signup": "PLANNED", "view": "VALIDATED", "click": "UPLOADING", "purchase": "REMOTE_VERIFIED", "error": "FAILED"}


def case(column: str, names: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in names.items()) + " END"


def legal(before: str, after: str) -> str:
    """SQL: whether a status may follow another."""
    return "(" + " OR ".join(f"({before} = '{a}' AND {after} IN ({', '.join(repr(b) for b in bs)}))" for a, bs in registry.LEGAL.items() if bs) + ")"


def follow(statuses: str) -> str:
    """SQL: the status that a list of them leads to."""
    return f"list_reduce(list_prepend('', {statuses}), lambda a, b: CASE WHEN {legal('a', 'b')} THEN b ELSE a END)"


JUDGED = """SELECT *, coalesce({legal}, false) AS applied FROM (SELECT *, {before} AS before FROM (SELECT *, coalesce(list(status) OVER (PARTITION BY key ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), []) AS earlier FROM ({rows})))"""


def judged_sql(rows: str, order: str) -> str:
    return JUDGED.format(rows=rows, order=order, before=follow("earlier"), legal=legal("before", "status"))


ORDERS = f"SELECT o_custkey AS key, o_orderkey AS seq, {case('o_orderpriority', ORDER_STATUS)} AS status FROM orders"


def order_events(t: Tables):
    status = F.expr(case("o_orderpriority", ORDER_STATUS))
    return t.orders.select(F.col("o_custkey").cast("string").alias("key"), F.col("o_orderkey").alias("seq"), status.alias("status"), F.to_json(F.struct("o_totalprice")).alias("payload"))


@query(f"SELECT key, arg_max(status, seq) AS status, max(seq)::BIGINT AS seq, count(*)::BIGINT AS applied FROM ({judged_sql(ORDERS, 'seq')}) WHERE applied GROUP BY key")
def registry_upsert(t: Tables):
    """Orders as events of their customer, upserted in two commits, the second with all of the first again; and once more, which writes nothing."""
    log, events = registry.Registry(t.spark, new_folder(t.spark, "registry")), order_events(t)
    middle = events.agg(F.expr("percentile_approx(seq, 0.5)")).first()[0]
    log.upsert(events.where(F.col("seq") <= F.lit(middle)))
    log.upsert(events)
    if log.upsert(events).version is not None:
        raise RuntimeError("events were applied twice")
    return log.state().select(F.col("key").cast("long").alias("key"), "status", "seq", "applied")


@query(f"SELECT key, seq, status, CASE WHEN applied THEN 'applied' ELSE 'illegal' END AS verdict FROM ({judged_sql(ORDERS, 'seq')})")
def registry_verdicts(t: Tables):
    """What an upsert into an empty log says of each order."""
    judged = registry.judged(order_events(t), registry.Registry(t.spark, new_folder(t.spark, "registry")).state())
    return judged.select(F.col("key").cast("long").alias("key"), "seq", "status", "verdict")


STATUS_SUMS = ", ".join(f"coalesce(sum(tokens) FILTER (status IN ({', '.join(repr(s) for s in registry.STATES[low:high])})), 0)::BIGINT AS {name}_tokens" for name, low, high in (("acquired", 1, 7), ("validated", 2, 6), ("uploaded", 3, 6), ("verified", 4, 6)))


@query(f"""SELECT 1000000::BIGINT AS target_tokens, *, greatest(1000000 - verified_tokens, 0)::BIGINT AS remaining_tokens, verified_tokens / 1000000 * 100 AS percentage_complete FROM (SELECT {STATUS_SUMS},
count(*) FILTER (status = 'FAILED')::BIGINT AS failed_shards, count(*) FILTER (status NOT IN ('COMPLETE', 'FAILED'))::BIGINT AS pending_shards FROM (SELECT o_orderkey % 1000 AS tokens, {case('o_orderpriority', ORDER_STATUS)} AS status FROM orders))""")
def corpus_progress_whole(t: Tables):
    """All figures of the progress report, with what remains of a target and the percentage."""
    return registry.progress(t.orders.select((F.col("o_orderkey") % 1000).alias("tokens"), F.expr(case("o_orderpriority", ORDER_STATUS)).alias("status")), 1_000_000)


EVENTS = f"SELECT user_id AS key, ts, event_id AS id, {case('event_type', EVENT_STATUS)} AS status FROM events"


@query(f"SELECT key, id, status, CASE WHEN applied THEN 'applied' ELSE 'illegal' END AS verdict, CASE WHEN applied THEN status ELSE before END AS state FROM ({judged_sql(EVENTS, 'ts, id')}) WHERE epoch_ms(ts) < (SELECT epoch_ms(max(ts)) - 3600000 FROM events)")
def stream_registry(t: Tables):
    """Events as a stream of files that are out of order inside: each in order of time, with its verdict, as far as the watermark of an hour came."""
    spark, folder = t.spark, new_folder(t.spark, "stream")
    rows = t.events.select(F.col("user_id").cast("string").alias("key"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("id"), F.expr(case("event_type", EVENT_STATUS)).alias("status"))
    # three ranges of time, one written after the other, each as two files that are sorted by anything but time
    ends = rows.agg(F.expr("percentile_approx(unix_micros(at), array(0.33, 0.67))")).first()[0] or [0, 0]
    for low, high in ((None, ends[0]), (ends[0], ends[1]), (ends[1], None)):
        part = rows.where((F.lit(low is None) | (F.unix_micros("at") > low)) & (F.lit(high is None) | (F.unix_micros("at") <= high)))
        part.repartition(2, F.xxhash64("id")).sortWithinPartitions(F.xxhash64("id")).write.mode("append").parquet(f"{folder}/in")
    stream = ordered_stream(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in"))
    stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    done = spark.read.schema(stream.schema).parquet(f"{folder}/out")
    return shared(done.select(F.col("key").cast("long").alias("key"), "id", "status", "verdict", "state"))


@query("SELECT item_id, CASE WHEN item_id % 2 = 0 THEN contains(text, CASE WHEN item_id % 5 = 0 THEN 'e' ELSE 'a' END) ELSE false END AS passed, item_id % 5 = 0 AS fresh FROM benchmark")
def eval_incremental(t: Tables):
    """Benchmark items as cases, scored once; then with every fifth case changed, which alone is scored again."""
    folder = new_folder(t.spark, "evaluations") + "/cache"
    k, changed = F.col("item_id"), F.col("item_id") % 5 == 0

    def cases(expected):
        kind = F.when(k % 2 == 0, "contains").otherwise("exact")
        return t.benchmark.select(k.cast("string").alias("id"), F.col("text").alias("prompt"), kind.alias("scoring"), F.when(k % 2 == 0, expected).otherwise("no such text").alias("expected"))

    def answer(rows):
        return rows.select("id", F.col("prompt").alias("output"))

    incremental.evaluate(cases(F.lit("a")), answer, {"model": "reference"}, folder)
    # an odd case expects the same text in both, so its prompt changes
    longer = F.when(F.col("id").cast("long") % 5 == 0, F.concat("prompt", F.lit(" "))).otherwise(F.col("prompt"))
    second = cases(F.when(changed, "e").otherwise("a")).withColumn("prompt", longer)
    done = incremental.evaluate(second, answer, {"model": "reference"}, folder)
    return done.results.select(F.col("id").cast("long").alias("item_id"), "passed", "fresh")
