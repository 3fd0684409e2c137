"""Read models built from the transition log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import any_of

SUMMARY_KEYS = ["workflow_name", "instance_id"]


def instance_summary(log: DataFrame) -> DataFrame:
    """One row per workflow instance, taken from its highest version.

    ``log`` holds applied transitions: workflow_name, instance_id, version, to_state,
    ts, event_type, actor_id. Repeated rows do not matter, and rows of one version are settled by
    all their values. An aggregation, no sort per instance: each task keeps one row per instance
    before the shuffle.
    """
    last = F.max_by(
        F.struct(
            F.col("to_state").alias("current_state"), F.col("ts").alias("updated_at"),
            F.col("event_type").alias("last_event_type"), F.col("actor_id").alias("last_actor"), "version",
        ),
        F.struct("version", "ts", "to_state", "event_type", "actor_id"),
    )
    return log.groupBy(*SUMMARY_KEYS).agg(last.alias("last")).select(*SUMMARY_KEYS, "last.*")


def rebuild(log: DataFrame, project=instance_summary) -> DataFrame:
    """Any projection from the whole log; by default the instance summary."""
    return project(log)


def state_counts(rm: DataFrame) -> DataFrame:
    """Instances per workflow and state, and when the newest changed."""
    return rm.groupBy("workflow_name", F.col("current_state").alias("state")).agg(
        F.count(F.lit(1)).alias("instances"), F.max("updated_at").alias("newest")
    )


def attachments(entities: DataFrame, documents: DataFrame, entity_type: str) -> DataFrame:
    """Documents per entity and the latest of them; entities without any show zero.

    ``entities`` has entity_id; documents are reduced per entity before the join.
    """
    latest = F.max_by(F.struct("id", "filename", "uploaded_at"), F.struct("uploaded_at", "id"))
    per_entity = (
        documents.filter(F.col("entity_type") == entity_type).groupBy("entity_id")
        .agg(F.count(F.lit(1)).alias("documents"), latest.alias("latest"))
    )
    return entities.select("entity_id").distinct().join(per_entity, "entity_id", "left").select(
        F.lit(entity_type).alias("entity_type"), "entity_id", F.coalesce("documents", F.lit(0)).alias("documents"),
        F.col("latest.id").alias("latest_id"), F.col("latest.filename").alias("latest_filename"),
        F.col("latest.uploaded_at").alias("latest_uploaded_at"),
    )


def read_model_page(
    rm: DataFrame, filters: dict | Column | None, order: list[str], limit: int, after: tuple | None = None
) -> DataFrame:
    """One page of a read model.

    ``order`` must end in a unique column; NULLs come first. ``after`` holds its values in the last
    row of the page before (None for NULL), so that going on does not read the pages already shown.
    """
    if isinstance(filters, dict):
        for name, value in filters.items():
            rm = rm.filter(F.col(name) == value)
    elif filters is not None:
        rm = rm.filter(filters)
    if after is not None:
        later, equal = [], F.lit(True)
        for name, value in zip(order, after, strict=True):
            beyond = F.col(name).isNotNull() if value is None else F.col(name) > value
            later.append(equal & F.coalesce(beyond, F.lit(False)))
            equal = equal & F.col(name).eqNullSafe(F.lit(value))
        if after[0] is not None:
            rm = rm.filter(F.col(order[0]) >= after[0])  # reaches the scan
        rm = rm.filter(any_of(later))
    return rm.orderBy(*[F.asc_nulls_first(name) for name in order]).limit(limit)
