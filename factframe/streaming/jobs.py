"""Sentences and change events as streams, with bounded state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def paused_sessions(words: DataFrame, pause: str = "6 hours", late: str = "1 day") -> DataFrame:
    """Words of a clip up to a pause: (clip_id, start, end, n). A session is given out once the watermark passes its end."""
    return (
        words.withWatermark("ts", late)
        .groupBy("clip_id", F.session_window("ts", pause).alias("w"))
        .agg(F.count("*").alias("n"), F.min("ts").alias("start"), F.max("ts").alias("end"))
        .select("clip_id", "start", "end", "n")
    )


def windowed_counts(facts: DataFrame, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Facts by entity and day; late ones within the watermark still count."""
    return facts.withWatermark("ts", late).groupBy("entity_id", F.window("ts", width).alias("w")).agg(F.count("*").alias("n"), F.max("value").alias("top")).select("entity_id", F.col("w.start").alias("start"), "n", "top")


def changes(facts: DataFrame, idle: str = "30 days") -> DataFrame:
    """Inserts and updates of a stream of (clip_id, entity_id, ts, value), in time order within each micro-batch.

    State is the last value of each entity and is dropped after `idle`
    without facts, as event time passes the watermark.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values("ts", kind="stable")
        known, out = state.get if state.exists else (None,), []
        for ts, value in zip(rows["ts"], rows["value"]):
            value = None if pd.isna(value) else int(value)
            if not state.exists and not out:
                out.append((*key, ts, "insert", value))
            elif value != known[0]:
                out.append((*key, ts, "update", value))
            known = (value,)
        state.update(known)
        state.setTimeoutTimestamp(int(rows["ts"].max().timestamp() * 1000) + int(pd.Timedelta(idle).total_seconds() * 1000))
        yield pd.DataFrame(out, columns=["clip_id", "entity_id", "ts", "event_type", "value"]).astype({"value": "Int64"})

    return facts.withWatermark("ts", "1 day").groupBy("clip_id", "entity_id").applyInPandasWithState(
        step, "clip_id bigint, entity_id string, ts timestamp, event_type string, value bigint", "value bigint", "append", GroupStateTimeout.EventTimeTimeout
    )
