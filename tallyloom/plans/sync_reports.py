"""Reports over the audit history of the syncs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.times import before, day_of


def latest_sync_per_entity(history: DataFrame) -> DataFrame:
    """Every row completed at the newest time of its entity; rows that tie are all kept."""
    newest = history.groupBy("entity_type").agg(F.max("sync_completed_at").alias("sync_completed_at"))
    return (
        history.join(newest, ["entity_type", "sync_completed_at"])
        .select("entity_type", "last_sync_timestamp", "records_synced", "sync_completed_at", "status", "error_message")
        .orderBy("entity_type")
    )


def sync_daily(history: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    return (
        history.where(F.col("sync_completed_at") >= before(as_of, days=days))
        .groupBy("entity_type", day_of("sync_completed_at").alias("sync_date"))
        .agg(
            F.sum("records_synced").alias("total_records"),
            F.count(F.lit(1)).alias("sync_count"),
            F.count_if(F.col("status") == "success").alias("successful_syncs"),
            F.count_if(F.col("status") == "failed").alias("failed_syncs"),
        )
        .orderBy(F.desc("sync_date"), "entity_type")
    )


def failed_syncs(history: DataFrame, limit: int | None = 20) -> DataFrame:
    ordered = (
        history.where(F.col("status") == "failed")
        .select("entity_type", "sync_started_at", "sync_completed_at", "records_synced", "error_message")
        .orderBy(F.desc_nulls_last("sync_completed_at"), F.desc("sync_started_at"), "entity_type")
    )
    return ordered if limit is None else ordered.limit(limit)


def recent_sync_log(history: DataFrame, limit: int = 10) -> DataFrame:
    return (
        history.orderBy(F.desc_nulls_last("sync_completed_at"), F.desc("sync_started_at"), "entity_type")
        .limit(limit)
        .select("entity_type", "last_sync_timestamp", "records_synced", "status", "sync_completed_at")
    )
