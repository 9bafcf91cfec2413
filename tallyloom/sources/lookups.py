"""Reads that take a parameter: incremental, bounded, by id, and id lists."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.times import to_seconds
from tallyloom.functions.values import truthy


def incremental(rows: DataFrame, watermark: int | None, time: str = "created", month: str | None = None) -> DataFrame:
    """Rows created after the watermark (Unix seconds); no watermark or 0 reads everything.

    `month` names a partition column with the month of `time`, so that whole partitions are skipped.
    """
    if not watermark:
        return rows
    mark = datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=watermark)
    newer = rows.where(F.col(time) > F.lit(mark.isoformat(" ")).cast("timestamp_ntz"))
    return newer if month is None else newer.where(F.col(month) >= F.lit(mark.date().replace(day=1)))


def is_newer(watermark: int | None, lookback: int = 0) -> Column:
    """The same on unflattened records, which carry `created` as seconds in their JSON.

    A record without a creation time counts as one of second 0, as in the tables: a lookback that reaches there takes it too.
    """
    if not watermark:
        return F.lit(True)
    created = F.get_json_object("json_data", "$.created").try_cast("bigint")
    return F.coalesce(created, F.lit(0).cast("long")) > watermark - lookback


def bounded(rows: DataFrame, limit: int, order: list[str | Column]) -> DataFrame:
    return rows.orderBy(*order).limit(limit)


def by_ids(wanted: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Point lookups in bulk: one output row per wanted id, with nulls where nothing is found."""
    return wanted.select(key).join(rows, key, "left")


def children_of(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """All children of the given parents. Children drive, so a crowded parent can be split."""
    return children.join(parents.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_semi")


def document_sections(documents: DataFrame, first: str, second: str) -> DataFrame:
    """(section, place, id) rows of JSON documents with two lists of {id}."""
    parts = [
        documents.select(
            F.lit(i).alias("section"),
            F.posexplode(F.from_json(F.get_json_object("body", f"$.{name}"), "array<struct<id:string>>")),
        ).select("section", F.col("pos").alias("place"), F.col("col.id").alias("id"))
        for i, name in enumerate((first, second))
    ]
    return parts[0].unionByName(parts[1])


def capped_ids(sections: DataFrame, cap: int, place: str = "place") -> DataFrame:
    """Up to half the cap from section 0, then as many of section 1 as still fit the cap.

    A row without an id uses up its place in the half but does not count towards the cap.
    Never more than `cap` rows leave the sort.
    """
    first = sections.where("section = 0").orderBy(place).limit(cap // 2).where("id is not null")
    second = sections.where("section = 1").orderBy(place).limit(cap)
    room = F.lit(cap) - first.agg(F.count(F.lit(1))).scalar()
    numbered = second.withColumn("n", F.row_number().over(Window.orderBy(place)))
    return first.select("id").unionByName(numbered.where(F.col("n") <= room).where("id is not null").select("id"))


def last_sync(history: DataFrame, entity: str, successful_only: bool = False) -> DataFrame:
    """The newest audit row of an entity as one row; a 'pending' row from epoch 0 if there is none.

    By default the newest row counts whatever its status. A failed run may have no watermark, so a
    sync asks for the newest successful row.
    """
    spark = history.sparkSession
    rows = history.where(F.col("entity_type") == entity)
    if successful_only:
        rows = rows.where(F.col("status") == "success")
    newest = (
        rows.orderBy(F.desc_nulls_last("sync_completed_at"), F.desc_nulls_last("sync_started_at"), "status")
        .limit(1)
        .select(
            "entity_type", to_seconds("last_sync_timestamp").alias("mark"), "last_synced_id", "records_synced",
            "status", F.lit(True).alias("found"),
        )
    )
    wanted = spark.range(1).select(F.lit(entity).alias("entity_type"))
    found = F.coalesce("found", F.lit(False))
    return wanted.join(newest, "entity_type", "left").select(
        "entity_type",
        F.when(found, F.col("mark")).otherwise(F.lit(0).cast("long")).alias("last_sync_timestamp"),
        "last_synced_id",
        F.when(found, F.col("records_synced")).otherwise(F.lit(0).cast("long")).alias("records_synced"),
        F.when(found, F.col("status")).otherwise("pending").alias("status"),
    )


def contactable(rows: DataFrame) -> DataFrame:
    """Rows with at least one of e-mail, phone and name."""
    return rows.where(F.coalesce(truthy("email"), truthy("phone"), truthy("name")).isNotNull())


def identified(rows: DataFrame) -> DataFrame:
    """Rows with at least one of client id, billing id and e-mail."""
    return rows.where(F.coalesce(truthy("client_id"), truthy("billing_id"), truthy("email")).isNotNull())

