"""Sessions of a stream of events, numbered per customer, equal to those of ``operators.sessions`` on the same events."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.dates import epoch_seconds

SECOND = 1_000_000  # times are whole microseconds
#: The sessions closed so far, and those that still can grow: first and last time and number of events of each, in order.
STATE = "closed long, starts array<long>, ends array<long>, events array<long>"


def sessionize_stream(events: DataFrame, customer: str, time: str, gap_seconds: int = 1800, delay: str = "1 hour") -> DataFrame:
    """One row per finished session: customer, session_id, session_start, session_end, events_in_session, session_duration_mins.

    A gap of more than ``gap_seconds`` whole seconds starts a new session; numbers count a customer's sessions from 1 by time. A
    session is finished, and comes out once, when the watermark (the latest time less ``delay``) has left it by more than
    the gap. An event behind the watermark is late: it is dropped by the state operator, so a finished session never changes.
    Without late events the result does not depend on how the stream is cut into batches. Events without a time are
    left out, as they never fall behind a watermark; a null customer is a customer. Use output mode append.

    State is one row per customer: a count, and the open sessions, which are few however many their events are. A batch's events of a
    customer pass through one task a chunk at a time.
    """
    kind = events.schema[time].dataType
    key = events.schema[customer].dataType.simpleString()
    timed = events.select(F.col(customer).alias("customer"), F.col(time).cast("timestamp").alias("time")).where("time IS NOT NULL")
    done = timed.withWatermark("time", delay).groupBy("customer").applyInPandasWithState(
        partial(_advance, gap=gap_seconds),
        f"customer {key}, session_id long, session_start timestamp, session_end timestamp, events_in_session long",
        STATE,
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    seconds = epoch_seconds(done, "session_end") - epoch_seconds(done, "session_start")
    return done.select(
        F.col("customer").alias(customer),
        "session_id",
        F.col("session_start").cast(kind).alias("session_start"),
        F.col("session_end").cast(kind).alias("session_end"),
        "events_in_session",
        F.round(seconds / F.lit(60), 1).alias("session_duration_mins"),
    )


def merged(starts: np.ndarray, ends: np.ndarray, events: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of time, joined where the pause between them is at most ``gap`` whole seconds."""
    order = np.argsort(starts, kind="stable")
    starts, ends, events = starts[order], np.maximum.accumulate(ends[order]), events[order]
    begins = np.flatnonzero(np.concatenate(([True], starts[1:] // SECOND - ends[:-1] // SECOND > gap)))
    last = np.concatenate((begins[1:] - 1, [len(starts) - 1]))
    return starts[begins], ends[last], np.add.reduceat(events, begins)


def _advance(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState, gap: int) -> Iterator[pd.DataFrame]:
    closed, *known = state.get if state.exists else (0, [], [], [])
    starts, ends, events = (np.array(values, dtype=np.int64) for values in known)
    if not state.hasTimedOut:
        for chunk in chunks:
            times = chunk["time"].to_numpy().astype("datetime64[us]").astype(np.int64)
            if len(times):
                ones = np.ones(len(times), dtype=np.int64)
                starts, ends, events = merged(*(np.concatenate(pair) for pair in ((starts, times), (ends, times), (events, ones))), gap)
    watermark = state.getCurrentWatermarkMs() * 1000
    # What comes from now on is not before the watermark.
    done = int(np.searchsorted(watermark // SECOND - ends // SECOND <= gap, True))
    rows = [(key[0], closed + k + 1, *(pd.Timestamp(t, unit="us") for t in (starts[k], ends[k])), int(events[k])) for k in range(done)]
    starts, ends, events = starts[done:], ends[done:], events[done:]
    state.update((closed + done, starts.tolist(), ends.tolist(), events.tolist()))
    if len(ends):
        finished = (int(ends[0]) // SECOND + gap + 1) * 1000
        state.setTimeoutTimestamp(max(finished, state.getCurrentWatermarkMs() + 1))
    yield pd.DataFrame(rows, columns=["customer", "session_id", "session_start", "session_end", "events_in_session"])
