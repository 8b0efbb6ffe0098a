"""Lease gaps (ST4): a silence longer than the lease means the task was delivered again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values, in seconds: length of a lease and how long before its end it is renewed.
LEASE_S = 300
RENEW_OFFSET_S = 10


def lease_sessions(renewals: DataFrame, lease_s: int = LEASE_S, delay: str | None = None) -> DataFrame:
    """Unbroken holds of each task; works on tables and, with ``delay``, on streams.

    ``renewals``: task_id, ts.
    """
    rows = renewals.withColumn("ts", F.col("ts").cast("timestamp"))
    if delay is not None:
        rows = rows.withWatermark("ts", delay)
    held = rows.groupBy("task_id", F.session_window("ts", f"{lease_s} seconds").alias("_w")).agg(F.count("*").alias("renewals"))
    return held.select("task_id", F.col("_w.start").alias("held_from"), F.col("_w.end").alias("held_until"), "renewals")


def redelivered(sessions: DataFrame) -> DataFrame:
    """Tasks held more than once, with the number of deliveries."""
    return sessions.groupBy("task_id").agg(F.count("*").alias("deliveries")).where("deliveries > 1")
