"""The tables of one installation, and the statements that create, fill and drop catalog tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.functions.times import from_seconds, moment
from tallyloom.operators.flatten import classify
from tallyloom.operators.upsert import seed_missing
from tallyloom.plans.snapshot import CLUSTER_COLUMNS
from tallyloom.sinks.buckets import BucketedTable
from tallyloom.sinks.log import Log
from tallyloom.sinks.tables import Table
from tallyloom.sources.landing import READ_FILE

# The entities of the billing sync, in the order they run.
ENTITIES = ("customers", "subscriptions")

# Months, not days: a batch touches few folders and files stay large.
CREATED_MONTH = ("created_month", "trunc(CAST(created AS DATE), 'month')")
COMPLETED_MONTH = ("completed_month", "trunc(CAST(sync_completed_at AS DATE), 'month')")
INGEST_DATE = ("ingest_date", "CAST(ingested_at AS DATE)")


class Store:
    """All tables under one folder that every executor can reach, with one commit log."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 16):
        """`buckets` is the number of hash buckets of the tables that syncs merge into; it stays what it was at first."""
        self.spark, self.folder, self.buckets = spark, folder, buckets
        self.log = Log(spark, folder)

    def _table(self, name: str, schema: str, kind: type[Table] = Table, **options) -> Table:
        return kind(self.spark, f"{self.folder}/{name}", schema, log=self.log, name=name, **options)

    @cached_property
    def raw(self) -> dict[str, Table]:
        return {e: self._table(f"raw_billing_{e}", schemas.RAW, partition=CREATED_MONTH) for e in ENTITIES}

    @cached_property
    def raw_tiers(self) -> Table:
        return self._table("raw_tiers", schemas.RAW_UNDATED)

    @cached_property
    def raw_mixed(self) -> Table:
        return self._table("raw_mixed", schemas.RAW_MIXED, partition=INGEST_DATE, one_value=True)

    @cached_property
    def raw_linked(self) -> Table:
        return self._table("raw_linked_customers", schemas.RAW_LINKED, partition=INGEST_DATE, one_value=True)

    @cached_property
    def billing(self) -> dict[str, Table]:
        return {
            "customers": self._table("b_customers", schemas.B_CUSTOMERS, BucketedTable, keys=["customer_id"], buckets=self.buckets),
            "subscriptions": self._table("b_subscriptions", schemas.B_SUBSCRIPTIONS, BucketedTable, keys=["subscription_id"], buckets=self.buckets),
        }

    @cached_property
    def membership(self) -> dict[str, Table]:
        return {
            "tiers": self._table("m_tiers", schemas.M_TIERS, keys=["product_id"]),
            "customers": self._table("m_customers", schemas.M_CUSTOMERS, keys=["client_id", "billing_id"],
                                     cluster=["billing_id", "client_id"]),
            "subscriptions": self._table("m_subscriptions", schemas.M_SUBSCRIPTIONS, keys=["subscription_id"],
                                         cluster=["billing_id", "subscription_id"]),
            "sessions": self._table("m_sessions", schemas.M_SESSIONS, keys=["session_id"],
                                    partition=("session_month", "trunc(CAST(session_date AS DATE), 'month')"), cluster=["session_id", "client_id"]),
            "assets": self._table("m_assets", schemas.M_ASSETS, keys=["asset_id", "client_id"],
                                  cluster=["asset_id", "billing_id", "client_id"]),
        }

    @cached_property
    def history(self) -> Table:
        return self._table("sync_history", schemas.SYNC_HISTORY, partition=COMPLETED_MONTH)

    @cached_property
    def quarantine(self) -> dict[str, Table]:
        """Records that could not be read, each in the batch that saw it first."""
        return {e: self._table(f"quarantine/{e}", "json_data string, reason string") for e in ENTITIES}

    @cached_property
    def landed(self) -> dict[str, Table]:
        """Files that were read, by the batch that read them."""
        return {e: self._table(f"landed/{e}", READ_FILE) for e in ENTITIES}

    @property
    def unified_path(self) -> str:
        return f"{self.folder}/unified_customers"

    @property
    def snapshot_path(self) -> str:
        return f"{self.folder}/bi_customer_360_snapshot"


# -- raw rows ------------------------------------------------------------------------------------


def raw_rows(records: DataFrame, ingested_at: Column) -> DataFrame:
    """(id, json_data, ingested_at, created) of landed records; a missing creation time is epoch 0."""
    second = F.coalesce(F.get_json_object("json_data", "$.created").try_cast("bigint"), F.lit(0).cast("long"))
    return records.select(
        F.get_json_object("json_data", "$.id").alias("id"), "json_data", ingested_at.alias("ingested_at"),
        from_seconds(second).alias("created"),
    )


def raw_tier_rows(records: DataFrame, ingested_at: Column) -> DataFrame:
    return records.select(
        F.coalesce(F.get_json_object("json_data", "$.id"), F.lit("")).alias("id"), "json_data",
        ingested_at.alias("ingested_at"),
    )


def raw_mixed_rows(records: DataFrame, order: list[str], ingested_at: Column) -> DataFrame:
    return classify(records, ("clientId", "sessionId"), order).select(
        "id", "record_type", "json_data", ingested_at.alias("ingested_at"), "feed_row"
    )


def raw_linked_rows(records: DataFrame, order: list[str], ingested_at: Column) -> DataFrame:
    return classify(records, ("clientId", "billingID"), order).select(
        "id", "json_data", ingested_at.alias("ingested_at"), "feed_row"
    )


# -- audit rows ----------------------------------------------------------------------------------


def audit_row(
    spark: SparkSession, entity: str, records: int, started: str, completed: str, status: str,
    watermark: int | None = None, error: str | None = None,
) -> DataFrame:
    """One line of sync history. A watermark of 0 is stored as none."""
    return spark.range(1).select(
        F.lit(entity).alias("entity_type"),
        from_seconds(F.lit(watermark or None).cast("long")).alias("last_sync_timestamp"),
        F.lit(None).cast("string").alias("last_synced_id"),
        F.lit(records).cast("long").alias("records_synced"),
        moment(started).alias("sync_started_at"), moment(completed).alias("sync_completed_at"),
        F.lit(status).alias("status"), F.lit(error).cast("string").alias("error_message"),
    )


def completion_audit_row(spark: SparkSession, entity: str, records: int, started: str, completed: str, status: str,
                         error: str | None = None) -> DataFrame:
    """The membership form: the watermark is the completion time, and only of a success."""
    row = audit_row(spark, entity, records, started, completed, status, None, error)
    mark = F.when(F.col("status") == "success", F.col("sync_completed_at"))
    return row.withColumn("last_sync_timestamp", mark)


def seed_rows(spark: SparkSession, entities: list[str]) -> DataFrame:
    """A pending row from epoch 0 for each entity."""
    return spark.range(1).select(
        F.explode(F.array(*[F.lit(e) for e in entities])).alias("entity_type"),
        moment("1970-01-01 00:00:00").alias("last_sync_timestamp"),
        F.lit(None).cast("string").alias("last_synced_id"), F.lit(0).cast("long").alias("records_synced"),
        F.lit(None).cast("timestamp_ntz").alias("sync_started_at"),
        F.lit(None).cast("timestamp_ntz").alias("sync_completed_at"),
        F.lit("pending").alias("status"), F.lit(None).cast("string").alias("error_message"),
    )


def seed_history(history: DataFrame, entities: list[str]) -> DataFrame:
    return seed_missing(history, seed_rows(history.sparkSession, entities), "entity_type")


# -- catalog -------------------------------------------------------------------------------------


def ensure_table(spark: SparkSession, name: str, schema: str, location: str, partition: str | None = None) -> None:
    """Creates a Parquet table in the catalog unless it is there already."""
    columns = f"{schema}, {partition} date" if partition else schema
    by = f"PARTITIONED BY ({partition})" if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {by} LOCATION '{location}'")


# Every table of an installation with its columns.
CATALOG = {
    **{f"raw_billing_{e}": schemas.RAW for e in ENTITIES}, "raw_tiers": schemas.RAW_UNDATED, "raw_mixed": schemas.RAW_MIXED,
    "raw_linked_customers": schemas.RAW_LINKED, "b_customers": schemas.B_CUSTOMERS, "b_subscriptions": schemas.B_SUBSCRIPTIONS,
    "m_tiers": schemas.M_TIERS, "m_customers": schemas.M_CUSTOMERS, "m_subscriptions": schemas.M_SUBSCRIPTIONS,
    "m_sessions": schemas.M_SESSIONS, "m_assets": schemas.M_ASSETS, "sync_history": schemas.SYNC_HISTORY,
}


def ensure_database(spark: SparkSession, database: str, folder: str) -> list[str]:
    """Creates the database and all its tables, unless they are there; returns the names of the tables.

    What is there stays as it is, with its rows.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}'")
    for name, schema in CATALOG.items():
        ensure_table(spark, f"{database}.{name}", schema, f"{folder}/{name}")
    return list(CATALOG)


def drop_tables(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def _named(path: str, log: Log | None) -> dict:
    """A table in a store's log, or with a log of its own."""
    return {} if log is None else {"log": log, "name": path.rsplit("/", 1)[1]}


def nested_table(unified: DataFrame, path: str, log: Log | None = None) -> Table:
    """The unified table."""
    return Table(unified.sparkSession, path, _ddl(unified), **_named(path, log))


def replace_nested(unified: DataFrame, path: str, batch: int, log: Log | None = None) -> DataFrame:
    """CREATE OR REPLACE TABLE AS for the unified table; the old version stays until this is complete."""
    table = nested_table(unified, path, log)
    table.replace(unified, batch)
    return table.read_base()


def snapshot_table(snapshot: DataFrame, path: str, log: Log | None = None) -> Table:
    """The BI table: partitioned by the month customers joined in, and dealt to files by the columns of the usual filters.

    Months instead of days keep files from getting small; the day stays a column, and readers
    filter on both.
    """
    return Table(
        snapshot.sparkSession, path, _ddl(snapshot), cluster=CLUSTER_COLUMNS,
        partition=("since_month", "trunc(membership_since, 'month')"), **_named(path, log),
    )


def replace_snapshot(snapshot: DataFrame, path: str, batch: int, log: Log | None = None) -> DataFrame:
    """A new content of the BI table, which is returned."""
    table = snapshot_table(snapshot, path, log)
    table.replace(snapshot, batch)
    return table.read_base()


def latest_version(spark: SparkSession, path: str, log: Log | None = None) -> DataFrame:
    """The last complete content of a table that is replaced as a whole, with the columns it was written with."""
    return Table(spark, path, "", **_named(path, log)).read_as_written()


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
