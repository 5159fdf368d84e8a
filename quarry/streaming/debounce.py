"""Debounce (R4): a burst of requests with pauses shorter than ``gap``
collapses to its last request — what the page script sends after the quiet
time. A pause of exactly ``gap`` starts a new burst.

Batch and stream use the same ``session_window`` aggregation. Sessions are
merged inside each map task before the shuffle
(``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``),
so a user with a third of all requests sends partial sessions, not raw rows.
The stream form needs a watermark: a session is emitted (append mode) once
the watermark passes its end, and its state is then dropped.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_UNITS_US = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
             "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def strict_gap(gap: str) -> str:
    """``session_window`` joins an event arriving exactly ``gap`` after the
    previous one to its session; a pause of exactly the quiet time must start
    a new burst, so the window gap is one microsecond (the timestamp
    resolution) shorter."""
    m = re.fullmatch(r"\s*(\d+)\s*(microsecond|millisecond|second|minute|hour|day)s?\s*", gap)
    if not m:
        raise ValueError(f"gap must look like '10 minutes', got {gap!r}")
    return f"{int(m.group(1)) * _UNITS_US[m.group(2)] - 1} microseconds"


def _sessions(events: DataFrame, gap: str) -> DataFrame:
    return (events.groupBy("user_id", F.session_window("ts", strict_gap(gap)).alias("w"))
            .agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type"))
            .select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start_ts"),
                    "event_type"))


def debounce(events: DataFrame, gap: str = "10 minutes") -> DataFrame:
    """``events(user_id, ts TIMESTAMP, event_id, event_type)`` →
    ``(user_id, start_ts, event_type)`` — one row per burst."""
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return _sessions(events, gap)


def debounce_stream(events: DataFrame, gap: str = "10 minutes",
                    watermark: str = "1 hour") -> DataFrame:
    """Streaming form (append mode once the watermark passes a session)."""
    return _sessions(events.withWatermark("ts", watermark), gap)
