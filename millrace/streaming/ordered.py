"""The fold of the registry as a stream: events of a key in order of time, whatever order they come in, each with its verdict.

An event waits in the key's state until the watermark has passed it, so that no earlier one can still come; a timer at the time of the
earliest one that waits lets them go, in order of time and then of id. What comes out is what `judged` of the registry says of the same
events as a table, for all events that the watermark has passed. An event behind the watermark is dropped, as its place in the
order is gone; one that repeats an id of its key is `stale` if the first has gone out, and is taken once if both wait.

State is a key's status, its last event, and what waits, so it is bounded by the events of a key within the delay. A query goes on from
its checkpoint with all that waited.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.registry import LEGAL, STATES

OUTPUT = "key string, at timestamp, id long, status string, verdict string, state string"
_STATE = "status string, last_us long, last_id long, us array<long>, ids array<long>, statuses array<string>"


def release(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """What the watermark has passed of a key's events, in order."""
    status, last_us, last_id, us, ids, statuses = state.get if state.exists else ("", None, None, [], [], [])
    waiting = set(zip(us, ids, statuses))
    for frame in frames:
        waiting.update((int(a), int(b), None if c is None or c != c else str(c)) for a, b, c in zip(frame["us"], frame["id"], frame["status"]))
    passed = state.getCurrentWatermarkMs()
    order = sorted(waiting, key=lambda e: (e[0], e[1], e[2] or ""))
    ready = [e for e in order if e[0] // 1000 < passed]
    rest = order[len(ready) :]
    rows = []
    for at, number, new in ready:
        if last_us is not None and (at, number) <= (last_us, last_id):
            verdict = "stale"
        elif new in LEGAL[status]:
            verdict, status = "applied", new
        else:
            verdict = "illegal"
        if verdict != "stale":
            last_us, last_id = at, number
        rows.append((key[0], pd.Timestamp(at, unit="us"), number, new, verdict, status))
    state.update((status, last_us, last_id, [e[0] for e in rest], [e[1] for e in rest], [e[2] for e in rest]))
    if rest:
        state.setTimeoutTimestamp(max(rest[0][0] // 1000, passed) + 1)
    if rows:
        yield pd.DataFrame(rows, columns=["key", "at", "id", "status", "verdict", "state"])


def ordered_stream(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """events: a stream of key, at (timestamp), id (long), status. Returns OUTPUT in append mode. Rows without key, at or id are left out."""
    rows = events.where("key is not null and at is not null and id is not null").select("key", "at", F.unix_micros("at").alias("us"), "id", "status")
    return rows.withWatermark("at", delay).groupBy("key").applyInPandasWithState(release, OUTPUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


assert set(LEGAL) == set(STATES)
