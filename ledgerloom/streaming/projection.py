"""Read models, deduplication and alerts kept current from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.projections import SUMMARY_KEYS, instance_summary
from ledgerloom.operators.workflow import INSTANCE
from ledgerloom.sources.sinks import compact_read_model, upsert_read_model, vacuum_read_model


def stream_instance_summary(
    log: DataFrame, path: str, checkpoint: str, writer: str = "main", compact_every: int | None = None, keep_seconds: float = 86_400
) -> StreamingQuery:
    """Keep the instance summary current from a stream of applied transitions.

    Each micro-batch is reduced to one row per instance before it is stored. The version
    decides, so repeated and late rows cannot set an instance back. After every ``compact_every`` batches
    these are folded into a new generation, and files that were replaced ``keep_seconds`` ago go, so that files stay bounded.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        upsert_read_model(instance_summary(batch), batch_id, path, SUMMARY_KEYS, "version", writer)
        if compact_every and batch_id % compact_every == compact_every - 1:
            # Old files first: what this compaction replaces is still being read.
            vacuum_read_model(batch.sparkSession, path, keep_seconds)
            compact_read_model(batch.sparkSession, path, SUMMARY_KEYS, "version")

    return (
        log.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_dedupe(events: DataFrame, delay: str = "7 days", time: str = "ts") -> DataFrame:
    """Drop events whose idempotency key was seen within the watermark delay.

    State is kept for the delay only; a key that returns later passes again. Exact
    deduplication for all time is part of `stream_replay`.
    """
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([*INSTANCE, "idempotency_key"])


def alert_stream(log: DataFrame, rules: DataFrame) -> DataFrame:
    """Transitions worth telling somebody about; works on batches and streams.

    ``rules`` has event_type, from_state (NULL for any) and alert.
    """
    known = rules.select(F.col("event_type").alias("rule_event"), F.col("from_state").alias("rule_state"), "alert")
    match = (F.col("event_type") == F.col("rule_event")) & (
        F.col("rule_state").isNull() | (F.col("rule_state") == F.col("from_state"))
    )
    return log.filter("outcome = 'applied'").join(known, match).select(
        *INSTANCE, "seq", "event_id", "ts", "alert", "from_state", "to_state", "actor_id"
    )
