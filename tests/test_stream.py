"""The registry's fold as a stream: equal to the table's, whatever the batches, and across a restart."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import registry as R
from millrace.streaming.ordered import ordered_stream

HOUR = 3_600_000_000
SCHEMA = "key string, at timestamp, id long, status string"


def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, us long, id long, status string").select("key", F.timestamp_micros("us").alias("at"), "id", "status")


def run(spark, folder, files=1):
    stream = ordered_stream(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(f"{folder}/in"), "1 hour")
    stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return sorted((r["key"], r["id"], r["status"], r["verdict"], r["state"]) for r in spark.read.parquet(f"{folder}/out").collect())


def expected(rows):
    """The fold in Python of all events that the watermark has passed."""
    end = max(us for _, us, _, _ in rows) // 1000 - HOUR // 1000
    out, state = [], {}
    for key, us, number, status in sorted(set(rows), key=lambda e: (e[1], e[2])):
        if us // 1000 < end:
            fits = status in R.LEGAL[state.get(key, "")]
            state[key] = status if fits else state.get(key, "")
            out.append((key, number, status, "applied" if fits else "illegal", state[key]))
    return sorted(out)


@pytest.mark.parametrize("seed", range(2))
def test_equals_the_fold_of_the_table_across_a_restart(spark, tmp_path, seed):
    r = random.Random(seed)
    rows = [(r.choice(["hot", "hot", "a", "b", "c"]), k * 60_000_000 + r.randint(-HOUR // 2, HOUR // 2) + 10 * HOUR, k, r.choice(R.STATES[1:])) for k in range(300)]
    folder = str(tmp_path)
    frame(spark, rows[:100]).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    first = run(spark, folder)
    assert first == expected(rows[:100])
    frame(spark, rows[100:200] + rows[190:200]).coalesce(1).write.mode("append").parquet(f"{folder}/in")  # some twice
    frame(spark, rows[200:]).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    assert run(spark, folder) == expected(rows)
    assert run(spark, folder) == expected(rows)  # nothing new, nothing twice


def test_late_and_repeated_events(spark, tmp_path):
    folder = str(tmp_path)
    t = 100 * HOUR
    frame(spark, [("a", t, 1, "PLANNED"), ("a", t + 1, 2, None), (None, t, 3, "PLANNED"), ("b", t + 3 * HOUR, 4, "PLANNED")]).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    assert run(spark, folder) == [("a", 1, "PLANNED", "applied", "PLANNED"), ("a", 2, None, "illegal", "PLANNED")]
    frame(spark, [("a", t + HOUR, 5, "VALIDATED"), ("a", t + 3 * HOUR, 6, "VALIDATED"), ("b", t + 9 * HOUR, 7, "FAILED")]).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    # 5 came behind the watermark, which stood at t + 2 hours

    assert [r for r in run(spark, folder) if r[1] == 5] == [] and len(run(spark, folder)) == 4
