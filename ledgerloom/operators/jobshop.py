"""Job progress and quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import pct


def _required_per_job(routings: DataFrame, ops: DataFrame) -> DataFrame:
    # Operations are counted per routing before they meet the routings.
    done = F.col("status") == "complete"
    per_routing = ops.groupBy("routing_id").agg(
        F.count_if("required").alias("required"), F.count_if(F.col("required") & done).alias("complete")
    )
    return (
        routings.select("routing_id", "job_id").join(per_routing, "routing_id")
        .groupBy("job_id").agg(F.sum("required").alias("required"), F.sum("complete").alias("complete"))
    )


def _quality(qa: DataFrame) -> DataFrame:
    """A job is approved when it has records and all of them are."""
    return qa.groupBy("job_id").agg(F.bool_and(F.col("status") == "approved").alias("approved"))


def job_progress(jobs: DataFrame, routings: DataFrame, ops: DataFrame, qa: DataFrame) -> DataFrame:
    """Required and finished operations per job, and its quality state."""
    return (
        jobs.select("job_id").join(_required_per_job(routings, ops), "job_id", "left").join(_quality(qa), "job_id", "left")
        .select(
            "job_id", F.coalesce("required", F.lit(0)).alias("required"), F.coalesce("complete", F.lit(0)).alias("complete"),
            pct(F.col("complete"), F.col("required")).alias("pct_complete"),
            F.when(F.col("approved"), "approved").when(F.col("approved").isNull(), "none").otherwise("open").alias("qa_status"),
        )
    )


def qa_violations(jobs: DataFrame, routings: DataFrame, ops: DataFrame, qa: DataFrame) -> DataFrame:
    """Jobs approved while required operations were incomplete."""
    lacking = _required_per_job(routings, ops).filter("complete < required")
    approved = _quality(qa).filter("approved").select("job_id")
    return (
        jobs.select("job_id").join(lacking, "job_id").join(approved, "job_id", "left_semi")
        .select("job_id", (F.col("required") - F.col("complete")).alias("incomplete"))
    )
