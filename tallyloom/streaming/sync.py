"""Batch syncs: incremental billing entities, full membership refresh, and the whole run.

Every step reads and writes stored tables. Only single numbers (watermark, counts) reach the
driver.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.functions.times import moment
from tallyloom.operators.contacts import chunk_bodies, contacts
from tallyloom.operators.flatten import (
    MemberFeed, flatten_customers, flatten_subscriptions, flatten_tiers, judged, parse_members, product_ids,
)
from tallyloom.operators.upsert import newest_where_repeated
from tallyloom.plans.snapshot import bi_snapshot
from tallyloom.plans.unified import unified_customers
from tallyloom.session import stored as stored_once
from tallyloom.sinks.log import delete
from tallyloom.sinks.store import (
    ENTITIES, Store, audit_row, completion_audit_row, latest_version, nested_table, raw_linked_rows, raw_rows, raw_tier_rows,
    snapshot_table,
)
from tallyloom.sources.landing import Landing
from tallyloom.sources.lookups import is_newer, last_sync

FLATTEN = {"customers": flatten_customers, "subscriptions": flatten_subscriptions}
RECORD = {"customers": schemas.BILLING_CUSTOMER, "subscriptions": schemas.BILLING_SUBSCRIPTION}


@dataclass(frozen=True)
class Outcome:
    step: str
    status: str
    rows: int = 0
    error: str | None = None


# Audit rows of one batch have numbers from batch * AUDIT_LINES on.
AUDIT_LINES = 10
# A table with so many batches on top of its base is folded into a new base at the end of a run.
COMPACT_AFTER = 8
# The reason staged records have that were taken by an earlier batch, or came too late for it.
OLD = "old"


def watermark(store: Store, entity: str, batch: int | None = None) -> int:
    """Where the last successful sync of an entity got to, or the last one before `batch`; 0 means from the beginning.

    A batch that runs again starts where it started the first time, so it reads the same records again.
    """
    history = store.history.read() if batch is None else store.history.read(below=batch * AUDIT_LINES)
    return last_sync(history, entity, successful_only=True).first()["last_sync_timestamp"] or 0


def new_watermark(raw: DataFrame) -> tuple[int, int]:
    """(rows, newest creation second) of a batch; records without one count as 0."""
    second = F.coalesce(F.get_json_object("json_data", "$.created").try_cast("bigint"), F.lit(0).cast("long"))
    row = raw.agg(F.count(F.lit(1)).alias("n"), F.max(second).alias("mark")).first()
    return row["n"], row["mark"] or 0


def _clock(now: str | None) -> str:
    return now or datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None).isoformat(" ")


@contextmanager
def _staging(store: Store, label: str) -> Iterator[str]:
    """The name of a folder for what only one step reads; it goes when the step is done or has failed."""
    path = f"{store.folder}/staging/{label}-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        delete(store.spark, path)


STAGED = "file string, json_data string, reason string, second long"


def _stage(entity: str, records: DataFrame, from_files: bool, mark: int, lookback: int, path: str) -> tuple[DataFrame, int, int]:
    """Judges records in one pass and stages the new ones: readable ones created after the watermark, and all unreadable ones.

    Those of files are all staged, with file and creation second, but old ones without their text and with reason 'old'. The number
    of new readable records and their newest creation second, 0 if there is none, are observed in the same pass.
    """
    # Unreadable records are kept whatever the watermark is, since they have no creation time.
    found = judged(records, RECORD[entity], "id")
    second = F.coalesce(F.get_json_object("json_data", "$.created").try_cast("bigint"), F.lit(0).cast("long"))
    if not from_files:
        found = found.where(is_newer(mark, lookback) | F.col("reason").isNotNull()).select(
            F.lit(None).cast("string").alias("file"), "json_data", "reason", F.when(F.col("reason").isNull(), second).alias("second")
        )
    else:
        reason = F.when(F.col("no_list"), "no list of records").otherwise(F.col("reason"))
        old = F.col("reason").isNull() & ~is_newer(mark, lookback)
        found = found.withColumn("reason", reason).select(
            "file", F.when(~old, F.col("json_data")).alias("json_data"), F.when(old, OLD).otherwise(F.col("reason")).alias("reason"),
            F.when(F.col("reason").isNull(), second).alias("second"),
        )
    seen, taken = Observation(), F.col("reason").isNull()
    found = found.observe(seen, F.count(F.when(taken, 1)).alias("n"), F.max(F.when(taken, F.col("second"))).alias("mark"))
    found.write.parquet(path)
    return found.sparkSession.read.schema(STAGED).parquet(path), seen.get["n"], seen.get["mark"] or 0


def sync_entity(
    store: Store, entity: str, records: DataFrame | Landing, batch: int, *, now: str | None = None, lookback: int = 0,
    allowed_bad: float = 0.0, send: Callable[[DataFrame], None] | None = None,
) -> Outcome:
    """One incremental sync of a billing entity.

    Reads records created after the watermark (minus `lookback` seconds, to catch late ones), adds
    them to the raw table, flattens them into the processed table, and writes an audit row. `send`
    receives the contact chunks of a customer sync; if it fails, a failed row is added.

    Records are those of a frame, or of the new files of a landing folder. Then files of earlier batches are not opened, except those
    that hold records created after the point from which this batch takes them (as with a larger `lookback`). The files are marked as
    read by the commit that adds their records, so a failed batch leaves them to the next one; a page that cannot be read counts
    as an unreadable record.

    Records are judged in one pass and staged. What the batch adds to the raw, quarantine and processed tables and the audit row
    become visible by one commit. A batch with too many unreadable records commits these and a failed audit row only. An unreadable
    record counts in the batch that sees it first. The same batch again, complete or not, folded or not, replaces what it added.
    """
    if entity not in ENTITIES:
        raise ValueError(f"unknown entity: {entity}")
    spark, started = store.spark, _clock(now)

    def audit(rows: int, status: str, mark: int | None = None, error: str | None = None, line: int = 0) -> None:
        row = audit_row(spark, entity, rows, started, _clock(now), status, mark, error)
        # Two lines per entity and batch: the sync itself and, for customers, a failed sending.
        number = batch * AUDIT_LINES + ENTITIES.index(entity) * 2 + line
        store.history.append(row, number)

    try:
        with _staging(store, f"{entity}-{batch}") as staging, store.log.transaction():
            mark = watermark(store, entity, batch)
            files = None
            if isinstance(records, Landing):
                files = records.unread(store.landed[entity].read(), batch, mark - lookback)
                records = records.contents([row["file"] for row in files.collect()])
            staged, count, newest = _stage(entity, records, files is not None, mark, lookback, staging)
            good = staged.where("reason is null").select("json_data")
            bad = staged.where(F.col("reason") != OLD).select("json_data", "reason")
            seen = store.quarantine[entity].read(below=batch).select("json_data").distinct()
            unreadable = store.quarantine[entity].append(bad.join(seen, "json_data", "left_anti"), batch)
            refused = unreadable > allowed_bad * (count + unreadable)
            if refused:
                error = f"{unreadable} of {count + unreadable} records of {entity} could not be read"
                audit(0, "failed", None, error)
            else:
                raw = store.raw[entity]
                raw.append(raw_rows(good, moment(started)), batch)
                stored = raw.read_batch(batch)
                if count:
                    store.billing[entity].append(FLATTEN[entity](stored, moment(started)), batch)
                if files is not None:
                    newest_in = staged.groupBy("file").agg(F.max("second").alias("newest"))
                    store.landed[entity].append(files.join(newest_in, "file", "left").withColumn("batch", F.lit(batch).cast("long")), batch)
                audit(count, "success", max(newest, mark))
    except Exception as problem:
        audit(0, "failed", None, str(problem))
        return Outcome(entity, "failed", 0, str(problem))
    if refused:
        return Outcome(entity, "failed", 0, error)
    if count == 0:
        return Outcome(entity, "success", 0)
    if entity == "customers" and send is not None:
        try:
            products = product_ids(store.raw["subscriptions"].read())
            send(chunk_bodies(contacts(FLATTEN[entity](stored), products)))
        except Exception as problem:
            audit(count, "failed", max(newest, mark), f"sending contacts failed: {problem}", line=1)
            return Outcome(entity, "failed", count, str(problem))
    return Outcome(entity, "success", count)


def refresh_membership(
    store: Store, tiers: DataFrame, linked: DataFrame, order: list[str], batch: int, *, now: str | None = None,
) -> Outcome:
    """Tiers, then linked customers with their subscriptions, assets and sessions.

    Everything but sessions is replaced by what came in. The feed carries only the latest session of
    a customer, so sessions are added and kept. With no linked customers the tables stay as they are.
    All tables and the audit rows become visible by one commit.
    """
    spark, started = store.spark, _clock(now)

    def audit(entity: str, rows: int, status: str, error: str | None = None, line: int = 0) -> None:
        row = completion_audit_row(spark, entity, rows, started, _clock(now), status, error)
        store.history.append(row, batch * AUDIT_LINES + 4 + line)

    try:
        with _staging(store, f"linked_customers-{batch}") as staging, store.log.transaction():
            return _refresh_membership(store, tiers, linked, order, batch, moment(started), audit, staging)
    except Exception as problem:
        audit("linked_customers", 0, "failed", str(problem), line=1)
        return Outcome("membership", "failed", 0, str(problem))


def _refresh_membership(store: Store, tiers: DataFrame, linked: DataFrame, order: list[str], batch: int, started: Column, audit, staging: str) -> Outcome:
    tier_count = store.raw_tiers.append(raw_tier_rows(tiers, started), batch)
    if tier_count:
        store.membership["tiers"].replace(flatten_tiers(store.raw_tiers.read_batch(batch), started), batch)
    audit("tiers", tier_count, "success")
    if linked.isEmpty():
        audit("linked_customers", 0, "success", line=1)
        return Outcome("membership", "success", 0)
    count = store.raw_linked.append(raw_linked_rows(linked, order, started), batch)
    stored = store.raw_linked.read_batch(batch)
    # Records are parsed once, and so are the texts of their cars; the four tables then read only the columns they need.
    parsed = stored_once(parse_members(stored, ["feed_row"], mixed=False), f"{staging}/records")
    feed = MemberFeed(parsed, ["feed_row"], mixed=False, synced_at=started)
    store.membership["customers"].replace(feed.customers(), batch)
    cars = stored_once(feed.assets(), f"{staging}/assets")
    for name, rows in (("subscriptions", feed.subscriptions()), ("assets", cars)):
        table = store.membership[name]
        table.replace(newest_where_repeated(rows, table.keys, table.newest_by), batch)
    store.membership["sessions"].append(feed.sessions(), batch)
    audit("linked_customers", count, "success", line=1)
    return Outcome("membership", "success", count)


def refresh_unified(store: Store, batch: int) -> Outcome:
    try:
        m = store.membership
        table = unified_customers(
            m["customers"].current(), store.billing["customers"].current(), store.billing["subscriptions"].current(),
            m["subscriptions"].current(), m["tiers"].current(), m["assets"].current(), m["sessions"].current(),
        ).withColumn("unified_refreshed_at", F.localtimestamp())
        return Outcome("unified_customers", "success", nested_table(table, store.unified_path, store.log).replace(table, batch))
    except Exception as problem:
        return Outcome("unified_customers", "failed", 0, str(problem))


def refresh_snapshot(store: Store, batch: int) -> Outcome:
    try:
        unified = latest_version(store.spark, store.unified_path, store.log)
        m = store.membership
        snapshot = bi_snapshot(
            unified, store.billing["subscriptions"].current(), m["subscriptions"].current(), m["assets"].current(),
            m["sessions"].current(), F.localtimestamp(),
        )
        return Outcome("bi_snapshot", "success", snapshot_table(snapshot, store.snapshot_path, store.log).replace(snapshot, batch))
    except Exception as problem:
        return Outcome("bi_snapshot", "failed", 0, str(problem))


def compact(store: Store, after: int | None = None) -> None:
    """Folds tables with many batches, so that a run does not read a folder for every run before it."""
    with store.log.transaction():
        for table in (*store.billing.values(), *store.membership.values(), *store.landed.values(), store.history):
            table.compact(COMPACT_AFTER if after is None else after)


def run_all(
    store: Store, batch: int, billing: Mapping[str, DataFrame | Landing], tiers: DataFrame | None = None,
    linked: DataFrame | None = None, order: list[str] | None = None, *, entities: list[str] | None = None,
    skip_membership: bool = False, now: str | None = None, lookback: int = 0, allowed_bad: float = 0.0,
    send: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """A whole run: membership, each billing entity, the unified table, the BI snapshot.

    Customers come after the other entities, so that the contacts sent for new customers name the products of this run.
    A step that fails does not stop the next one, except that the snapshot needs the unified table.
    Tables with many small batches are folded at the end.
    Returns (step, status, rows, error) with a last row for the run as a whole.
    """
    outcomes = []
    if skip_membership:
        outcomes.append(Outcome("membership", "skipped"))
    else:
        outcomes.append(refresh_membership(store, tiers, linked, order or [], batch, now=now))
    for entity in sorted(ENTITIES if entities is None else entities, key=lambda e: e == "customers"):
        try:
            outcomes.append(sync_entity(
                store, entity, billing[entity], batch, now=now, lookback=lookback, allowed_bad=allowed_bad, send=send))
        except Exception as problem:
            outcomes.append(Outcome(entity, "failed", 0, str(problem)))
    unified = refresh_unified(store, batch)
    outcomes.append(unified)
    if unified.status == "success":
        outcomes.append(refresh_snapshot(store, batch))
    else:
        outcomes.append(Outcome("bi_snapshot", "skipped", 0, "the unified table was not refreshed"))
    compact(store)
    failed = any(o.status == "failed" for o in outcomes) or unified.status != "success"
    outcomes.append(Outcome("run", "failed" if failed else "success"))
    return as_table(store.spark, outcomes)


def as_table(spark: SparkSession, outcomes: list[Outcome]) -> DataFrame:
    return spark.createDataFrame(
        [(o.step, o.status, o.rows, o.error) for o in outcomes], "step string, status string, rows long, error string"
    )
