"""Presence of consumers derived from their events: sessions that end after a timeout.

A consumer is present from an event until ``timeout`` after its last one (an event exactly at
the end of a session still belongs to it). The same function serves batch frames and streams:
session windows are Spark's own, so on a stream their state is bounded by the watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sessions(events: DataFrame, key: str, ts: str, timeout: str) -> DataFrame:
    """``(key, since, until, n_events)`` per session; ``until`` is the last event plus the timeout.

    On a stream give ``events`` a watermark on ``ts``; later events than that are left out, and a
    session is emitted once (append mode) when the watermark has passed its end. Partial sessions
    are merged before the shuffle, so a consumer with very many events costs a row per task and session.
    """
    w = F.session_window(ts, timeout)
    return (events.groupBy(key, w.alias("_w")).agg(F.count(F.lit(1)).alias("n_events"))
            .select(key, F.col("_w.start").alias("since"), F.col("_w.end").alias("until"), "n_events"))


def latest(sessions_: DataFrame, key: str) -> DataFrame:
    """The last session of every consumer: its latest state."""
    return (sessions_.groupBy(key).agg(F.max("since").alias("since"), F.max("until").alias("until"), F.count(F.lit(1)).alias("n_sessions"),
                                       F.sum("n_events").alias("n_events")))


def present(latest_: DataFrame, at: Column) -> DataFrame:
    """The latest states with ``present``: whether the last session reaches the instant ``at``."""
    return latest_.withColumn("present", F.col("until") >= at)
