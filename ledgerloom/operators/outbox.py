"""Outbox messages: what is due, what happened last, what is retried."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def due_messages(outbox: DataFrame, now, limit: int) -> DataFrame:
    """Pending messages whose time has come, oldest first."""
    return (
        outbox.filter((F.col("status") == "pending") & (F.col("next_attempt_at") <= F.lit(now)))
        .orderBy("next_attempt_at", "message_id").limit(limit)
    )


def latest_delivery(attempts: DataFrame) -> DataFrame:
    """Last attempt of each message; kept by aggregation, without sorting a message's attempts."""
    # Equal attempts are settled by their other values.
    last = F.max(F.struct("attempt", "attempted_at", "status")).alias("last")
    return attempts.groupBy("message_id").agg(last).select("message_id", "last.attempt", "last.status", "last.attempted_at")


def retry_schedule(attempts: DataFrame, base: int = 60, factor: int = 2, max_attempts: int = 5) -> DataFrame:
    """Messages whose last attempt failed and when to try them again.

    The wait is ``base`` seconds times ``factor`` for each attempt after the first.
    """
    failed = latest_delivery(attempts).filter((F.col("status") == "failed") & (F.col("attempt") < max_attempts))
    wait = (F.lit(base) * F.pow(F.lit(factor), F.col("attempt") - 1)).cast("long")
    # A whole number of seconds added to the timestamp.
    return failed.select(
        "message_id", "attempt",
        (F.col("attempted_at") + F.make_dt_interval(secs=wait.cast("decimal(18,6)"))).alias("next_attempt_at"),
    )


def dead_letters(attempts: DataFrame, max_attempts: int = 5) -> DataFrame:
    """Messages that failed as often as allowed."""
    return latest_delivery(attempts).filter((F.col("status") == "failed") & (F.col("attempt") >= max_attempts)).select(
        "message_id", F.col("attempt").alias("attempts"), F.col("attempted_at").alias("failed_at")
    )
