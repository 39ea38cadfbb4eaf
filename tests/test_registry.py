"""The log of shards against a fold in Python: replays, illegal transitions, hot keys, conflicts, and progress."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import registry as R


def brute(events, state):
    """Verdicts of events in order, on a copy of state: key -> (status, seq)."""
    known = dict(state)
    out = {}
    now = {k: s for k, (s, _) in state.items()}
    for key, seq, status in sorted(set(events), key=lambda e: (e[0] is not None, e[0] or "", e[1] is not None, e[1] or 0, e[2] is not None, e[2] or "")):
        if key in known and key is not None and (seq is None or known[key][1] is not None and seq <= known[key][1]):
            out[key, seq, status] = "stale"
        elif key is not None and status in R.STATES[1:] and status in R.LEGAL[now.get(key, "")]:
            now[key] = status
            out[key, seq, status] = "applied"
        else:
            out[key, seq, status] = "illegal"
    return out


def frame(spark, events):
    return spark.createDataFrame([(k, q, s, None) for k, q, s in events], R.EVENT).repartition(3)


def verdicts(df):
    return {(r["key"], r["seq"], r["status"]): r["verdict"] for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_folds_like_one_list(spark, seed):
    r = random.Random(seed)
    keys = ["hot"] * 40 + [f"k{i}" for i in range(20)]
    events = [(r.choice(keys), r.randint(0, 400), r.choice(R.STATES[1:])) for _ in range(900)]
    events += [(None, 1, "PLANNED"), ("k1", None, "PLANNED"), ("k2", 5, None), ("k2", 6, "DONE"), ("k3", 0, ""), ("", 1, "PLANNED"), ("", 2, "VALIDATED")]
    held = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that a key spans parts
    try:
        state = {"k4": ("UPLOADING", 50), "k5": ("COMPLETE", 3), "hot": ("VALIDATED", 10), "k6": ("FAILED", None)}
        df = R.judged(frame(spark, events), spark.createDataFrame([(k, s, q) for k, (s, q) in state.items()], "key string, status string, seq long"))
        got = df.collect()
        assert len(got) == len(set(events))
        assert verdicts(df) == brute(events, state)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", held)


def test_applying_again_writes_nothing(spark, tmp_path):
    log = R.Registry(spark, str(tmp_path / "log"))
    assert log.state().collect() == [] and log.versions() == []
    first = [("a", 1, "PLANNED"), ("a", 2, "VALIDATED"), ("a", 3, "COMPLETE"), ("b", 1, "UPLOADING")]
    done = log.upsert(frame(spark, first))
    assert done.version == 1 and verdicts(done.judged) == {first[0]: "applied", first[1]: "applied", first[2]: "illegal", first[3]: "illegal"}
    again = log.upsert(frame(spark, first))
    assert again.version is None and log.versions() == [1]
    more = [("a", 3, "UPLOADING"), ("a", 4, "REMOTE_VERIFIED"), ("a", 5, "COMPLETE"), ("a", 6, "FAILED"), *first]
    assert log.upsert(frame(spark, more)).version == 2
    assert [tuple(r) for r in log.state().collect()] == [("a", "COMPLETE", 5, None, 5)]
    assert [tuple(r)[:3] for r in log.state(1).collect()] == [("a", "VALIDATED", 2)]
    assert log.upsert(frame(spark, [("a", 9, s) for s in R.STATES[1:]])).version is None  # complete is the end


def test_a_commit_that_comes_second_is_worked_out_again(spark, tmp_path, monkeypatch):
    one, two = R.Registry(spark, str(tmp_path / "log")), R.Registry(spark, str(tmp_path / "log"))
    commit, calls = R.Registry._commit, []

    def late(self, rows, version):
        if self is one and not calls:
            calls.append(1)
            two.upsert(frame(spark, [("a", 1, "PLANNED"), ("b", 1, "PLANNED")]))
        return commit(self, rows, version)

    monkeypatch.setattr(R.Registry, "_commit", late)
    done = one.upsert(frame(spark, [("a", 1, "PLANNED"), ("a", 2, "VALIDATED")]))
    assert done.version == 2 and verdicts(done.judged) == {("a", 1, "PLANNED"): "stale", ("a", 2, "VALIDATED"): "applied"}
    assert sorted((r["key"], r["status"]) for r in one.state().collect()) == [("a", "VALIDATED"), ("b", "PLANNED")]
    assert not list((tmp_path / "log").glob("_draft*"))


def test_progress(spark):
    rows = [("PLANNED", 5), ("VALIDATED", 7), ("UPLOADING", 11), ("REMOTE_VERIFIED", 13), ("COMPLETE", 17), ("FAILED", 19), ("OTHER", 23), (None, 29), ("COMPLETE", None)]
    got = R.progress(spark.createDataFrame(rows, "status string, tokens long"), 60).first().asDict()
    assert got == {"target_tokens": 60, "acquired_tokens": 72, "validated_tokens": 48, "uploaded_tokens": 41, "verified_tokens": 30, "failed_shards": 1, "pending_shards": 5, "remaining_tokens": 30, "percentage_complete": 50.0}
    assert R.progress(spark.createDataFrame(rows[:0], "status string, tokens long"), 60).select(F.sum("remaining_tokens")).first()[0] == 60
