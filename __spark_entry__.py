"""Registry of queries: one entry per operator, each over the whole of the given tables."""

from __future__ import annotations

import itertools
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

if (_here := str(Path(__file__).resolve().parent)) not in sys.path:
    sys.path.insert(0, _here)

from oracle.queries import ORACLE  # noqa: E402
from tallyloom import schemas, session  # noqa: E402
from tallyloom.functions import times, values  # noqa: E402
from tallyloom.operators import contacts, exports, flatten, matching, nesting, upsert  # noqa: E402
from tallyloom.operators.ordinals import number_rows  # noqa: E402
from tallyloom.plans import customers, invoices, quality, revenue, snapshot, summaries, sync_reports, unified  # noqa: E402
from tallyloom.sinks import store  # noqa: E402
from tallyloom.sinks.buckets import BucketedTable  # noqa: E402
from tallyloom.sinks.tables import Table  # noqa: E402
from tallyloom.sources import landed, lookups, pages  # noqa: E402
from tallyloom.sources.fixtures import Tables  # noqa: E402
from tallyloom.sources.landing import Landing  # noqa: E402
from tallyloom.streaming import feed, sync  # noqa: E402

# Reports on a moving window take the moment they report for.
SYNC_AS_OF = "2024-01-31 00:00:00"
ENDING_AS_OF = "2001-07-01 00:00:00"
INVOICE_AS_OF = "2001-08-01 00:00:00"
RECENT_AS_OF = "1996-01-01 00:00:00"
FRESH_AS_OF = "2024-03-01 00:00:00"
SYNCED_AT = "2024-02-02 00:00:00"
CUT = "1997-01-01 00:00:00"
CUT_SECONDS = 852076800
# Queries whose tasks are kept small: they sort whole rows of the largest tables.
SMALL_TASKS = ("latest_car", "join_tiers_dim")
# Records in one landing file.
LANDED_RECORDS = 500_000
# Pages in one landing file of a stream, at least.
LANDED_PAGES = 1000

c = F.col
Query = Callable[[Tables], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        REGISTRY[name] = build
        return build

    return add


def entry(spark: SparkSession) -> DataFrame:
    """The flagship: one nested record per customer, shown with its arrays as key lists."""
    return queries()["unified_customers"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(name: str, build: Query) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            session.apply_settings(spark)
            tables = Tables(spark, folder)
            session.fit_tasks(spark, tables.paths if name in SMALL_TASKS else None)
            return build(tables)

        return run

    return {name: bind(name, build) for name, build in REGISTRY.items()} | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return {name: text for name, text in ORACLE.items() if name in REGISTRY} | _training_data()[1]


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators, if that part of the repository is present."""
    try:
        import corpus_pipeline
        from tallyloom.llm import queries as training
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "tallyloom.llm"):
            raise
        return {}, {}
    sql = training.ORACLE | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return training.QUERIES | {"pipeline": corpus_pipeline.run}, sql


def _table(t: Tables, label: str, schema: str, **options) -> Table:
    return Table(t.spark, session.scratch(t.spark, label), schema, **options)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


# -- sources -------------------------------------------------------------------------------------


def _customer_pages(t: Tables) -> DataFrame:
    return landed.pages(landed.customer_records(t.b_customers), landed.key_number("customer_id"))


def _flat_customers(raw: DataFrame) -> DataFrame:
    return flatten.flatten_customers(raw).drop("updated_at", "ingested_at")


@query("scan_page_envelopes")
def _(t):
    return _flat_customers(pages.envelopes(_customer_pages(t)))


@query("scan_list_or_envelope")
def _(t):
    records = landed.tier_records(t.m_tiers)
    found = pages.list_or_envelope(landed.pages(records, landed.key_number("product_id"), "any"))
    return found.select(F.get_json_object("json_data", "$.id").alias("id"), "page")


@query("scan_unreadable_pages")
def _(t):
    records = landed.tier_records(t.m_tiers)
    return pages.unreadable(landed.pages(records, landed.key_number("product_id"), "any")).select("page", "reason")


@query("scan_incremental")
def _(t):
    return lookups.incremental(t.b_customers, CUT_SECONDS).select("customer_id", "name", "created")


@query("scan_bounded")
def _(t):
    rows = lookups.bounded(t.b_subscriptions, 100, ["created", "subscription_id"])
    return rows.select("subscription_id", "customer_id", "created", "amount_cents")


@query("scan_tier_pages")
def _(t):
    records = landed.tier_records(t.m_tiers)
    read = pages.envelopes(landed.pages(records, landed.key_number("product_id")), follow="100")
    return flatten.flatten_tiers(read).drop("updated_at", "ingested_at")


@query("scan_cursor_pages")
def _(t):
    records = landed.linked_feed(t.m_customers, t.m_subscriptions, summaries.session_summary(t.m_sessions)).where(
        "feed_kind = 0"
    )
    read = pages.envelopes(landed.pages(records, landed.key_number("feed_key"), "nextCursor"), "nextCursor")
    r = pages.as_records(read, schemas.LINKED_MEMBER)
    return r.select(
        c("clientId").alias("client_id"), c("billingID").alias("billing_id"), "email",
        c("latestSession.sessionId").alias("session_id"),
    )


@query("scan_by_id")
def _(t):
    wanted = t.m_customers.where("billing_id is not null").select(c("billing_id").alias("customer_id"))
    return lookups.by_ids(wanted, t.b_customers, "customer_id").select("customer_id", "email", "balance")


@query("scan_children_of")
def _(t):
    found = lookups.children_of(t.b_customers.where("delinquent"), t.b_subscriptions, "customer_id", "customer_id")
    return found.select("customer_id", "subscription_id", "status", "product_id")


@query("scan_id_sections")
def _(t):
    sections = t.b_customers.select(
        F.when(c("phone").isNull(), 1).otherwise(0).alias("section"),
        landed.key_number("customer_id").alias("place"), c("customer_id").alias("id"),
    )
    return lookups.capped_ids(sections, 200)


@query("scan_table")
def _(t):
    return t.base("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


@query("scan_last_sync")
def _(t):
    return lookups.last_sync(t.sync_history, "click")


# -- sinks ---------------------------------------------------------------------------------------


@query("sink_raw_append")
def _(t):
    table = _table(t, "raw", schemas.RAW, partition=store.CREATED_MONTH)
    records = landed.subscription_records(t.b_subscriptions)
    table.append(store.raw_rows(records, times.moment(SYNCED_AT)), 1)
    return table.read().select(
        "id", "ingested_at", "created", "created_month", F.get_json_object("json_data", "$.status").alias("status")
    )


@query("sink_raw_tiers")
def _(t):
    table = _table(t, "raw-tiers", schemas.RAW_UNDATED)
    table.append(store.raw_tier_rows(landed.tier_records(t.m_tiers), times.moment(SYNCED_AT)), 1)
    return table.read().select("id", "ingested_at", F.get_json_object("json_data", "$.name").alias("name"))


def _mixed(t: Tables) -> DataFrame:
    return landed.mixed_feed(t.m_customers, t.m_subscriptions, t.m_sessions)


def _linked(t: Tables) -> DataFrame:
    return landed.linked_feed(t.m_customers, t.m_subscriptions, summaries.session_summary(t.m_sessions))


FEED_ORDER = ["feed_kind", "feed_key"]


@query("sink_raw_mixed")
def _(t):
    table = _table(t, "raw-mixed", schemas.RAW_MIXED, partition=store.INGEST_DATE, one_value=True)
    table.append(store.raw_mixed_rows(_mixed(t), FEED_ORDER, times.moment(SYNCED_AT)), 1)
    return table.read().select("id", "record_type", "ingested_at")


@query("sink_raw_linked")
def _(t):
    table = _table(t, "raw-linked", schemas.RAW_LINKED, partition=store.INGEST_DATE, one_value=True)
    table.append(store.raw_linked_rows(_linked(t), FEED_ORDER, times.moment(SYNCED_AT)), 1)
    return table.read().select("id", "ingested_at")


@query("upsert_latest")
def _(t):
    rows = t.b_invoices
    table = BucketedTable(t.spark, session.scratch(t.spark, "upsert"), _ddl(rows), keys=["invoice_id"])
    earlier = c("created") < times.moment("1999-01-01 00:00:00")
    table.append(rows.where(earlier), 1)
    table.compact()
    table.append(rows.where(~earlier), 2)
    return table.current()


@query("sink_full_refresh")
def _(t):
    table = _table(t, "refresh", _ddl(t.m_customers))
    table.replace(t.m_customers.where("billing_id is null"), 1)
    table.replace(t.m_customers, 2)
    return table.read().select("client_id", "billing_id", "email")


@query("ctas_unified")
def _(t):
    return _unified_flat(store.replace_nested(_unified(t), session.scratch(t.spark, "unified"), 1))


@query("ctas_bi_partitioned")
def _(t):
    table = store.replace_snapshot(_snapshot(t), session.scratch(t.spark, "snapshot"), 1)
    return _snapshot_flat(table).withColumn("since_month", c("since_month"))


@query("clustered_lookup")
def _(t):
    """Customers of the BI table by a range of ids, from the files that can hold them."""
    rows = _snapshot(t)
    table = store.snapshot_table(rows, session.scratch(t.spark, "snapshot"))
    table.replace(rows, 1)
    return _snapshot_flat(table.find("client_id", "cl_2", "cl_4")).withColumn("since_month", c("since_month"))


@query("create_views")
def _(t):
    return store.create_view(revenue.mrr_by_month(t.b_subscriptions), "mrr_summary")


@query("seed_merge_not_matched")
def _(t):
    return store.seed_history(t.sync_history, ["customers", "subscriptions", "click"]).drop("last_synced_id")


@query("append_sync_history")
def _(t):
    table = _table(t, "history", schemas.SYNC_HISTORY, partition=store.COMPLETED_MONTH)
    table.append(t.sync_history, 1)
    table.append(store.audit_row(t.spark, "customers", 5, SYNCED_AT, SYNCED_AT, "success", CUT_SECONDS), 2)
    table.append(store.completion_audit_row(t.spark, "tiers", 7, SYNCED_AT, SYNCED_AT, "failed", "no answer"), 3)
    return table.read().drop("last_synced_id", "completed_month")


@query("ensure_tables")
def _(t):
    spark, name, folder = t.spark, "tallyloom_sync_history", session.scratch(t.spark, "catalog")
    rows = t.sync_history.withColumn("completed_date", times.day_of("sync_completed_at"))
    store.drop_tables(spark, [name])
    for _attempt in range(2):
        store.ensure_table(spark, name, schemas.SYNC_HISTORY, folder, "completed_date")
    rows.hint("rebalance", "completed_date").write.insertInto(name, overwrite=True)
    return spark.table(name).drop("last_synced_id")


@query("ensure_database")
def _(t):
    """All tables are created, some are filled, one is dropped, and all are created again but for one nobody ever made."""
    spark, name, folder = t.spark, "tallyloom_installation", session.scratch(t.spark, "database")
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    wanted = store.ensure_database(spark, name, folder)
    for label, rows in (("sync_history", t.sync_history), ("m_tiers", t.m_tiers), ("m_sessions", t.m_sessions)):
        whole = spark.createDataFrame([], store.CATALOG[label]).unionByName(rows, allowMissingColumns=True)
        whole.select(*spark.table(f"{name}.{label}").columns).write.insertInto(f"{name}.{label}")
    store.drop_tables(spark, [f"{name}.m_assets"])
    before = quality.table_report(spark, name, ["m_assets", "m_tiers"]).withColumn("moment", F.lit("dropped"))
    store.ensure_database(spark, name, folder)
    after = quality.table_report(spark, name, [*wanted, "b_refunds"]).withColumn("moment", F.lit("ensured"))
    return before.unionByName(after)


@query("drop_legacy")
def _(t):
    spark, names = t.spark, ["tallyloom_staging_customers", "tallyloom_staging_sessions"]
    store.drop_tables(spark, names)
    for name, rows in zip(names, (t.m_customers, t.m_sessions), strict=True):
        rows.write.option("path", session.scratch(spark, name)).saveAsTable(name)
    present = 2 - len(quality.missing_tables(spark, names))
    counts = [spark.table(name).count() for name in names]
    store.drop_tables(spark, names)
    gone = len(quality.missing_tables(spark, names))
    return t.m_tiers.agg(
        F.count(F.lit(1)).alias("tiers"), F.lit(sum(counts)).cast("long").alias("staged_rows"),
        F.lit(present).alias("tables_before"), F.lit(2 - gone).alias("tables_after"),
    )


def _export_inputs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        landed.subscription_records(t.b_subscriptions), landed.customer_records(t.b_customers),
        landed.payment_method_records(t.b_customers),
    )


def _read_export(t: Tables, rows: DataFrame, label: str) -> DataFrame:
    path = session.scratch(t.spark, label)
    exports.write_export(rows, path)
    ddl = ", ".join(f"{n} string" for n in rows.columns)
    text = t.spark.read.schema(ddl).option("header", True).option("emptyValue", "").csv(path)
    back = text.withColumns({"created_timestamp": c("created_timestamp").cast("long"), "amount": c("amount").cast("double")})
    return back.withColumns({n: F.coalesce(n, F.lit("")) for n, kind in back.dtypes if kind == "string"})


@query("export_subscriptions")
def _(t):
    return _read_export(t, exports.subscription_rows(*_export_inputs(t)), "export")


@query("export_customers")
def _(t):
    return _read_export(t, exports.customer_rows(*_export_inputs(t), limit=None), "export-customers")


def _contacts(t: Tables) -> DataFrame:
    products = flatten.product_ids(landed.subscription_records(t.b_subscriptions, expanded=True))
    return contacts.contacts(t.b_customers, products)


@query("sink_contact_batches")
def _(t):
    rows = contacts.chunks(_contacts(t), 1000)
    return rows.select("contact_no", "chunk", "customer_id", "product_id")


@query("contact_bodies")
def _(t):
    bodies = contacts.chunk_bodies(_contacts(t), ["new"], 1000)
    return bodies.select(
        "chunk", "contacts", F.get_json_object("body", "$.tags[0]").alias("tag"),
        F.get_json_object("body", "$.customers[0].customer_id").alias("first_customer"),
    )


@query("quarantine_bad_records")
def _(t):
    records = landed.customer_records(t.b_customers).join(
        t.b_customers.select("customer_id", "delinquent", "name"), "customer_id"
    )
    cut_off = F.substring("json_data", 1, 20)
    nameless = F.concat(F.lit('{"id":"","email":"'), c("customer_id"), F.lit('"}'))
    landed_rows = records.withColumn(
        "json_data", F.when(c("delinquent"), cut_off).when(c("name").isNull(), nameless).otherwise(c("json_data"))
    )
    good, bad = flatten.quarantine(landed_rows, schemas.BILLING_CUSTOMER, "id")
    kept = good.select("customer_id", F.lit("kept").alias("outcome"))
    return kept.unionByName(bad.select("customer_id", c("reason").alias("outcome")))


# -- projections ---------------------------------------------------------------------------------


@query("flatten_customers")
def _(t):
    return _flat_customers(landed.customer_records(t.b_customers))


@query("flatten_subscriptions")
def _(t):
    flat = flatten.flatten_subscriptions(landed.subscription_records(t.b_subscriptions))
    return flat.drop("updated_at", "ingested_at")


@query("flatten_tiers")
def _(t):
    return flatten.flatten_tiers(landed.tier_records(t.m_tiers)).drop("updated_at", "ingested_at")


def _mixed_part(part: str) -> Query:
    return lambda t: getattr(flatten.MemberFeed(_mixed(t), FEED_ORDER, mixed=True), part)().drop(
        "updated_at", "ingested_at", "json_data"
    )


def _linked_part(part: str) -> Query:
    return lambda t: getattr(flatten.MemberFeed(_linked(t), FEED_ORDER, mixed=False), part)().drop(
        "updated_at", "ingested_at", "json_data"
    )


def _joined_ids(build: Query) -> Query:
    return lambda t: build(t).withColumn("asset_ids", F.array_join("asset_ids", ","))


for _part in ("customers", "subscriptions", "sessions", "assets"):
    for _label, _maker in (("mixed", _mixed_part), ("linked", _linked_part)):
        _built = _maker(_part)
        REGISTRY[f"split_{_label}_{_part}"] = _joined_ids(_built) if _part == "subscriptions" else _built


@query("classify_raw_record")
def _(t):
    subs = t.m_subscriptions.select(
        F.lit(0).alias("kind"), c("subscription_id").alias("key"), c("updated_at").alias("at"),
        F.to_json(F.struct(F.when(c("status") != "paused", c("client_id")).alias("clientId"))).alias("json_data"),
    )
    visits = t.m_sessions.select(
        F.lit(1).alias("kind"), c("session_id").alias("key"), c("session_date").alias("at"),
        F.to_json(F.struct(
            F.when(c("session_type") == "click", c("client_id")).alias("clientId"), c("session_id").alias("sessionId"),
        )).alias("json_data"),
    )
    rows = subs.unionByName(visits)
    found = flatten.classify(rows, ("clientId", "sessionId"), ["kind", "key", "at"])
    return found.select("feed_row", "id", "record_type")


@query("extract_subscription_rows")
def _(t):
    return exports.subscription_rows(*_export_inputs(t))


@query("extract_customer_rows")
def _(t):
    return exports.customer_rows(*_export_inputs(t))


@query("product_ids_of_subscription")
def _(t):
    found = flatten.product_ids(landed.subscription_records(t.b_subscriptions, expanded=True))
    return found.select("subscription_id", "customer_id", c("place").cast("long").alias("place"), "product_id")


@query("contact_payloads")
def _(t):
    body = contacts.payloads(_contacts(t))
    return body.select(
        "customer_id", "product_id", *[F.get_json_object("payload", f"$.{f}").alias(f) for f in ("email", "name", "phone")],
        F.size(F.json_object_keys("payload")).cast("long").alias("fields"),
    )


@query("full_name")
def _(t):
    return t.m_customers.select("client_id", values.full_name("first_name", "last_name").alias("full_name"))


def _member_records(t: Tables) -> DataFrame:
    """Member records with many per billing id: one per subscription, numbered by time and id."""
    return t.m_subscriptions.select(
        "billing_id", "client_id", "subscription_id", "updated_at", "product_id", "status",
        F.lit(None).cast("string").alias("first_name"), c("status").alias("last_name"), c("product_id").alias("email"),
    )


MEMBER_ORDER = ["updated_at", "subscription_id"]


@query("match_display_fields")
def _(t):
    m = matching.cross_match(t.b_customers, _member_records(t), MEMBER_ORDER)
    return m.select(
        "billing_id", matching.display_name("name", "member_first_name", "member_last_name").alias("display_name"),
        matching.display_email("email", "member_email").alias("display_email"),
    )


@query("customer_status")
def _(t):
    latest = summaries.billing_summary(t.b_subscriptions)
    return t.b_customers.select("customer_id").join(latest, "customer_id", "left").select(
        "customer_id", snapshot.customer_status("latest.status").alias("customer_status")
    )


@query("renewal_status")
def _(t):
    return t.b_subscriptions.select("subscription_id", revenue.renewal_status().alias("renewal_status"))


@query("unified_projection")
def _(t):
    flat = unified.unified_scalars(t.m_customers, t.b_customers, t.m_subscriptions, t.m_tiers)
    return flat


@query("membership_probe_classes")
def _(t):
    return matching.membership_probe(t.b_customers, t.m_customers, t.m_subscriptions)


@query("membership_probe_summary")
def _(t):
    return matching.probe_summary(matching.membership_probe(t.b_customers, t.m_customers, t.m_subscriptions))


# -- filters -------------------------------------------------------------------------------------


@query("filter_status_eq")
def _(t):
    return t.b_subscriptions.where(c("status") == "active").select("subscription_id", "customer_id")


@query("filter_not_null")
def _(t):
    return t.b_customers.where(c("address_country").isNotNull()).select("customer_id", "address_country")


@query("filter_bool")
def _(t):
    rows = t.b_invoice_amounts.where(c("attempted") & ~c("paid"))
    return rows.select("invoice_id", "created", "amount_due")


@query("filter_last_n")
def _(t):
    rows = t.sync_history.where(c("sync_completed_at") >= times.before(SYNC_AS_OF, days=30))
    return rows.select("entity_type", "sync_completed_at", "status")


@query("filter_between_next_n")
def _(t):
    window = (times.moment(ENDING_AS_OF), times.after(ENDING_AS_OF, days=7))
    return t.b_subscriptions.where(c("current_period_end").between(*window)).select("subscription_id", "current_period_end")


@query("filter_overdue")
def _(t):
    late = (c("status") != "paid") & (c("due_date") < times.moment(INVOICE_AS_OF)) & (c("amount_remaining") > 0)
    return t.b_invoice_amounts.where(late).select("invoice_id", "due_date", "amount_remaining")


@query("filter_array_non_empty")
def _(t):
    people = unified.with_counts(_people(t), [unified.session_children(t.m_sessions)])
    return people.where("sessions_count > 0").select("client_id", c("sessions_count").alias("session_count"))


@query("filter_param")
def _(t):
    store.create_view(t.sync_history, "tallyloom_history")
    return t.spark.sql(
        "SELECT entity_type, sync_completed_at, status FROM tallyloom_history WHERE entity_type = :entity",
        args={"entity": "purchase"},
    )


@query("filter_any_identity")
def _(t):
    rows = t.m_customers.withColumn("client_id", F.when(c("email").isNotNull(), c("client_id")).otherwise(""))
    return lookups.identified(rows).select("client_id", "billing_id", "email")


@query("filter_any_contact")
def _(t):
    return lookups.contactable(t.b_customers).select("customer_id", "email", "phone", "name")


@query("filter_rank_one")
def _(t):
    newest = upsert.newest_per_key(
        t.b_subscriptions.select("customer_id", "created", "subscription_id", "status"), ["customer_id"],
        ["created", "subscription_id"],
    )
    return newest


# -- joins ---------------------------------------------------------------------------------------


@query("cross_match")
def _(t):
    m = matching.cross_match(t.b_customers, _member_records(t), MEMBER_ORDER)
    return m.select(
        "billing_id", "email", "name", "member_client_id", "member_subscription_id", "member_updated_at", "member_status"
    )


@query("cross_match_summary")
def _(t):
    return matching.cross_match_summary(t.b_customers, _member_records(t))


@query("join_both_systems")
def _(t):
    return unified.join_both_systems(t.m_customers, t.b_customers).select(
        "client_id", "billing_id", "full_name", "billing_name", "billing_email", "address_country"
    )


@query("join_left_chain")
def _(t):
    base = unified.join_both_systems(t.m_customers, t.b_customers).select("client_id", "billing_id")
    parts = {
        "billing_total": summaries.billing_summary(t.b_subscriptions).withColumnRenamed("customer_id", "billing_id"),
        "membership_total": summaries.membership_summary(t.m_subscriptions),
        "asset_total": summaries.asset_summary(t.m_assets),
    }
    for name, part in parts.items():
        base = base.join(part.select("billing_id", c("total").alias(name)), "billing_id", "left")
    visits = summaries.session_summary(t.m_sessions).select("client_id", c("total").alias("session_total"))
    base = base.join(summaries.tiers_used(t.m_subscriptions), "billing_id", "left").join(visits, "client_id", "left")
    return base.join(summaries.current_tier(t.m_subscriptions, t.m_tiers), "billing_id", "left")


@query("join_bi_chain")
def _(t):
    return _snapshot_flat(_snapshot(t)).select(
        "client_id", "billing_id", "customer_status", "latest_billing_sub_id", "latest_membership_sub_id",
        "latest_session_id", "latest_asset_model", "total_assets", "distinct_tiers_used",
    )


@query("enrich_subscriptions")
def _(t):
    rows = exports.enrich(*_export_inputs(t))
    return rows.select(
        c("s.id").alias("subscription_id"), c("c.id").alias("customer_id"), c("c.name").alias("name"),
        c("p.id").alias("payment_method"),
    )


@query("join_tiers_dim")
def _(t):
    rows = unified.with_tiers(t.m_subscriptions, t.m_tiers)
    return rows.select("subscription_id", "product_id", "updated_at", "tier_name", "tier_key", "tier_perks")


@query("customer_active_value")
def _(t):
    return customers.active_value(t.b_customers, t.b_subscriptions)


@query("customer_360_literal")
def _(t):
    return customers.customer_360(t.b_customers, t.b_subscriptions, t.b_invoices, multiplied=True)


@query("customer_360")
def _(t):
    return customers.customer_360(t.b_customers, t.b_subscriptions, t.b_invoices)


@query("join_cohort")
def _(t):
    joined = t.b_invoices.where("paid").join(
        t.b_customers.select("customer_id", times.month_of("created").alias("cohort_month")), "customer_id"
    )
    return joined.select("invoice_id", "customer_id", "created", "amount_paid", "cohort_month")


def _people(t: Tables) -> DataFrame:
    return unified.join_both_systems(t.m_customers, t.b_customers)


@query("unnest_cars")
def _(t):
    return unified.unnest(_people(t), unified.asset_children(t.m_assets), ["client_id", "email", "full_name"])


@query("unnest_sessions")
def _(t):
    return unified.unnest(_people(t), unified.session_children(t.m_sessions), ["client_id", "email"])


@query("unnest_subs_with_tiers")
def _(t):
    child = unified.membership_subscription_children(t.m_subscriptions, t.m_tiers)
    return unified.unnest(_people(t), child, ["client_id", "email"])


@query("unnest_billing_subscriptions")
def _(t):
    return unified.unnest(_people(t), unified.billing_subscription_children(t.b_subscriptions), ["client_id"])


@query("latest_sync_per_entity")
def _(t):
    return sync_reports.latest_sync_per_entity(t.sync_history)


@query("anti_missing")
def _(t):
    return t.m_subscriptions.join(t.m_tiers, "product_id", "left_anti").select("subscription_id", "product_id", "updated_at")


@query("scalar_subquery_counts")
def _(t):
    rows = F.count(F.lit(1))
    return t.b_customers.agg(
        rows.alias("customers"),
    ).select(
        "customers", t.b_subscriptions.agg(rows).scalar().alias("subscriptions"),
        t.b_invoice_amounts.agg(rows).scalar().alias("invoices"),
        (t.b_invoice_amounts.agg(rows).scalar() - t.b_subscriptions.agg(rows).scalar()).alias("difference"),
    )


# -- aggregations --------------------------------------------------------------------------------


@query("agg_count_sum_avg")
def _(t):
    return revenue.status_summary(t.b_subscriptions)


@query("mrr_by_plan")
def _(t):
    return revenue.mrr_by(t.b_subscriptions, "plan_name", "subscription_interval", "currency")


@query("mrr_by_plan_name")
def _(t):
    return revenue.mrr_by(t.b_subscriptions, "plan_name")


@query("mrr_by_plan_interval")
def _(t):
    return revenue.mrr_by(t.b_subscriptions, "plan_name", "subscription_interval")


@query("mrr_by_month")
def _(t):
    return revenue.mrr_by_month(t.b_subscriptions)


@query("sync_daily")
def _(t):
    return sync_reports.sync_daily(t.sync_history, SYNC_AS_OF, 30)


@query("churn_by_month")
def _(t):
    return revenue.churn_by_month(t.b_subscriptions)


@query("revenue_by_month")
def _(t):
    return invoices.revenue_by_month(t.b_invoice_amounts)


@query("invoice_status")
def _(t):
    return invoices.payment_status(t.b_invoice_amounts)


@query("failed_payments_daily")
def _(t):
    return invoices.failed_payments_daily(t.b_invoice_amounts)


@query("agg_conditional")
def _(t):
    active = c("status") == "active"
    return t.b_subscriptions.groupBy("plan_name").agg(
        F.sum(F.when(active, c("amount_cents")).otherwise(0)).alias("active_cents"),
        F.countDistinct(F.when(active, c("customer_id"))).alias("active_customers"),
    )


@query("agg_count_distinct")
def _(t):
    return t.b_subscriptions.groupBy("status").agg(
        F.countDistinct("product_id").alias("products"), F.countDistinct("customer_id", "plan_name").alias("customer_plans")
    )


@query("agg_array_struct_ordered")
def _(t):
    arrays = nesting.nested(unified.billing_subscription_children(t.b_subscriptions))
    items = c("billing_subscriptions")
    return arrays.select(
        "customer_id", F.size(items).cast("long").alias("n"),
        F.array_join(F.transform(items, lambda x: x["subscription_id"]), ",").alias("ids"),
        F.array_join(F.transform(items, lambda x: x["sub_amount_cents"].cast("string")), ",").alias("amounts"),
    )


@query("agg_array_distinct_non_null")
def _(t):
    arrays = nesting.nested(unified.billing_product_children(t.b_subscriptions))
    ids = F.transform("billing_product_ids", lambda x: x["product_id"])
    return arrays.select("customer_id", F.array_join(ids, ",").alias("product_ids"))


@query("agg_min_max_dates")
def _(t):
    return summaries.session_summary(t.m_sessions).select("client_id", "total", "first_date", "last_date")


@query("dedup_first_seen")
def _(t):
    rows = t.m_subscriptions.select("client_id", "billing_id", "updated_at", "subscription_id", "product_id")
    return upsert.first_seen(rows, ["client_id", "billing_id"], ["updated_at", "subscription_id"])


@query("dedup_ordered_list")
def _(t):
    products = flatten.product_ids(landed.subscription_records(t.b_subscriptions, expanded=True))
    lists = contacts.ordered_products(products)
    return lists.select("customer_id", F.array_join("products", ",").alias("products"))


@query("customer_date_range")
def _(t):
    return customers.date_range(customers.with_created_second(t.b_customers))


@query("sub_counts")
def _(t):
    billing = summaries.billing_summary(t.b_subscriptions).select(
        c("customer_id").alias("billing_id"), c("total").alias("billing_total"), c("active").alias("billing_active"),
        c("canceled").alias("billing_canceled"),
    )
    members = summaries.membership_summary(t.m_subscriptions).select(
        "billing_id", c("total").alias("membership_total"), c("active").alias("membership_active")
    )
    assets = summaries.asset_summary(t.m_assets).select("billing_id", c("total").alias("assets"))
    joined = billing.join(members, "billing_id", "full").join(summaries.tiers_used(t.m_subscriptions), "billing_id", "left")
    return joined.join(assets, "billing_id", "left")


@query("table_row_counts")
def _(t):
    return quality.row_counts({
        "b_customers": t.b_customers, "b_subscriptions": t.b_subscriptions, "b_invoices": t.b_invoice_amounts,
        "m_customers": t.m_customers, "m_subscriptions": t.base("lineitem"), "m_tiers": t.m_tiers,
        "m_sessions": t.m_sessions, "m_assets": t.m_assets, "sync_history": t.sync_history,
        "raw_billing_customers": landed.customer_records(t.b_customers),
        "raw_billing_subscriptions": landed.subscription_records(t.b_subscriptions),
        "raw_tiers": landed.tier_records(t.m_tiers), "unified_customers": _people(t),
    })


@query("new_high_watermark")
def _(t):
    records = landed.customer_records(t.b_customers)
    second = F.get_json_object("json_data", "$.created").try_cast("bigint")
    return records.agg(F.count(F.lit(1)).alias("records"), F.max(F.coalesce(second, F.lit(0))).alias("watermark"))


@query("top_customers_12mo")
def _(t):
    return invoices.top_customers(t.b_customers, t.b_invoices, INVOICE_AS_OF)


# -- windows -------------------------------------------------------------------------------------


@query("latest_billing_sub")
def _(t):
    return summaries.billing_summary(t.b_subscriptions).select("customer_id", "latest.*").drop("is_active")


@query("latest_membership_sub")
def _(t):
    return summaries.membership_summary(t.m_subscriptions).select("billing_id", "latest.*").drop("is_active")


@query("current_tier")
def _(t):
    return summaries.current_tier(t.m_subscriptions, t.m_tiers)


@query("latest_session")
def _(t):
    return summaries.session_summary(t.m_sessions).select("client_id", "latest.*")


@query("latest_car")
def _(t):
    return summaries.asset_summary(t.m_assets).select("billing_id", "latest.*")


@query("running_total")
def _(t):
    return customers.running_count(t.b_subscriptions, "created", "new_subscriptions", "cumulative_subscriptions")


@query("share_of_total")
def _(t):
    counts = t.b_subscriptions.groupBy("plan_name").agg(F.count(F.lit(1)).alias("subscription_count"))
    return revenue.share_of_total(counts, "subscription_count")


# -- sort and limit ------------------------------------------------------------------------------


@query("order_multi")
def _(t):
    order = ["status", "plan_name", "amount_cents", "subscription_id"]
    rows = t.b_subscriptions.select("subscription_id", "status", "plan_name", "amount_cents")
    return number_rows(rows, order, "position", descending=["status", "amount_cents"])


@query("topk_subscriptions")
def _(t):
    rows = t.b_subscriptions.orderBy(F.desc("amount_cents"), "subscription_id").limit(50)
    return rows.select("subscription_id", "customer_id", "amount_cents")


@query("limit_unordered")
def _(t):
    rows = unified.join_both_systems(t.m_customers, t.b_customers).orderBy("client_id").limit(20)
    return rows.select("client_id", "billing_id", "full_name")


@query("null_order")
def _(t):
    """Where nulls go: the place of every row in descending and in ascending order."""
    rows = t.sync_history.select("entity_type", "sync_completed_at", "sync_started_at")
    order = ["sync_completed_at", "sync_started_at"]
    last, first = (number_rows(rows, order, "position", descending) for descending in (order[:1], ()))
    return last.withColumn("direction", F.lit("desc")).unionByName(first.withColumn("direction", F.lit("asc")))


# -- set operations ------------------------------------------------------------------------------


@query("dq_duplicates")
def _(t):
    return quality.duplicates({
        "customers": (t.b_customers, "customer_id"), "subscriptions": (t.b_subscriptions, "subscription_id"),
        "invoices": (t.b_invoice_amounts, "invoice_id"),
    })


@query("dq_freshness")
def _(t):
    return quality.freshness(
        {"customers": t.b_customers, "subscriptions": t.b_subscriptions, "invoices": t.b_invoice_amounts}, FRESH_AS_OF
    )


@query("dq_raw_vs_processed")
def _(t):
    def processed(rows: DataFrame, key: str) -> DataFrame:
        return upsert.newest_per_key(rows, [key], ["ingested_at"])

    return quality.raw_against_processed({
        "customers": (landed.customer_records(t.b_customers), processed(t.b_customers, "customer_id")),
        "subscriptions": (landed.subscription_records(t.b_subscriptions), processed(t.b_subscriptions, "subscription_id")),
        "invoices": (t.b_invoice_amounts, processed(t.b_invoice_amounts, "invoice_id")),
    })


@query("union_seed_rows")
def _(t):
    seeds = store.seed_rows(t.spark, ["customers", "subscriptions"])
    return t.sync_history.unionByName(seeds).groupBy("entity_type").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("records_synced").alias("records_synced"),
        F.count_if(c("status") == "pending").alias("pending"),
    )


@query("union_distinct_keep_first")
def _(t):
    listed = t.b_customers.where("delinquent").select(c("customer_id").alias("id"))
    more = t.m_customers.where("billing_id is not null").select(c("billing_id").alias("id"))
    return upsert.append_unlisted(listed, more, "id")


# -- scalar functions ----------------------------------------------------------------------------


@query("scalar_datetime")
def _(t):
    as_of = times.moment("2002-01-01 12:30:00")
    return t.b_subscriptions.select(
        "subscription_id", times.day_of("canceled_at").alias("canceled_day"), times.month_of("canceled_at").alias("month"),
        (c("canceled_at") - F.expr("INTERVAL 1 MONTH")).alias("month_before"),
        (c("canceled_at") + F.expr("INTERVAL 7 DAY")).alias("week_after"),
        times.elapsed("DAY", "canceled_at", as_of).alias("days"), times.elapsed("HOUR", "canceled_at", as_of).alias("hours"),
        times.months_between_firsts(times.month_of("created"), times.month_of("canceled_at")).alias("months"),
        times.to_seconds("canceled_at").alias("seconds"),
        times.from_seconds(times.to_seconds("canceled_at")).alias("back_again"),
        times.printed(times.to_seconds("canceled_at")).alias("printed"),
    )


@query("scalar_string")
def _(t):
    return t.b_customers.select(
        "customer_id", values.first_truthy("email", "phone", "name").alias("reach"), values.truthy("email").alias("email"),
        F.coalesce("email", F.lit("none")).alias("plain"), values.full_name("name", "phone").alias("joined"),
        F.initcap(F.replace(c("object_type"), F.lit("_"), F.lit(" "))).alias("title"),
        values.is_truthy("email").alias("has_email"),
    )


@query("scalar_json")
def _(t):
    packed = landed.subscription_records(t.b_subscriptions, expanded=True)
    r = packed.select(F.from_json("json_data", schemas.BILLING_SUBSCRIPTION).alias("r"), "json_data")
    first = F.get("r.items.data", F.lit(0))
    return r.select(
        c("r.id").alias("subscription_id"), F.get_json_object("json_data", "$.status").alias("status"),
        first["price"]["recurring"]["interval"].alias("plan_interval"),
        F.startswith(F.coalesce(first["price"]["product"], F.lit("")), F.lit("{")).alias("product_is_object"),
        F.get("r.items.data", F.lit(5))["price"]["id"].alias("sixth_item"),
        c("r.created").alias("created_seconds"),
    )


@query("scalar_array")
def _(t):
    pairs = t.b_subscriptions.where("product_id is not null").select("customer_id", "product_id").distinct()
    arrays = nesting.nested(nesting.Children("ids", pairs, "customer_id", ("product_id",), ("product_id",)))
    ids = F.coalesce("ids", F.array().cast(arrays.schema["ids"].dataType))
    return t.b_customers.select("customer_id").join(arrays, "customer_id", "left").select(
        "customer_id", F.size(ids).cast("long").alias("n"), F.get(ids, F.lit(0))["product_id"].alias("first_id"),
    )


@query("scalar_math")
def _(t):
    return t.b_customers.select(
        "customer_id", values.dollars("balance").alias("balance_usd"), F.round(c("balance") / 1000, 1).alias("rounded"),
        (landed.key_number("customer_id") / 2).alias("half"),
        F.try_divide(c("balance"), landed.key_number("customer_id")).alias("safe_ratio"),
        (c("created").isNotNull() & c("delinquent")).alias("flag"),
        F.when(c("balance") < 0, "owes").when(c("balance") == 0, "even").otherwise("credit").alias("standing"),
        c("address_postal_code").try_cast("bigint").alias("postal_number"),
        c("name").try_cast("bigint").alias("not_a_number"),
    )


# -- incremental and streaming -------------------------------------------------------------------


def _store(t: Tables, label: str) -> store.Store:
    return store.Store(t.spark, session.scratch(t.spark, label))


def _compressed(records: DataFrame) -> DataFrameWriter:
    """A writer of landing files: records repeat their field names, and a compressed file is read by one task."""
    return records.write.option("compression", "gzip").option("maxRecordsPerFile", LANDED_RECORDS)


def _landed(t: Tables, records: DataFrame, label: str) -> DataFrame:
    """Records as files: one JSON text per line."""
    path = session.scratch(t.spark, label)
    _compressed(records.select("json_data")).text(path)
    return t.spark.read.text(path).withColumnRenamed("value", "json_data")


def _customer_increments(t: Tables) -> tuple[DataFrame, DataFrame]:
    """All customer records, and those created up to the cut."""
    everything = _landed(t, landed.customer_records(t.b_customers), "customers")
    created = F.get_json_object("json_data", "$.created").try_cast("bigint")
    return everything, everything.where(F.coalesce(created, F.lit(0)) <= CUT_SECONDS)


@query("incremental_sync")
def _(t):
    s, (everything, early) = _store(t, "incremental"), _customer_increments(t)
    sync.sync_entity(s, "customers", early, 1, now="2024-02-01 00:00:00")
    sync.sync_entity(s, "customers", everything, 2, now="2024-02-02 00:00:00")
    return s.billing["customers"].current().drop("updated_at", "ingested_at")


@query("incremental_sync_history")
def _(t):
    s, (everything, early) = _store(t, "incremental"), _customer_increments(t)
    for batch, records in enumerate((early, everything, everything), start=1):
        sync.sync_entity(s, "customers", records, batch, now=f"2024-02-0{batch} 00:00:00")
    return s.history.read().select("entity_type", "last_sync_timestamp", "records_synced", "sync_completed_at", "status")


def _stored_customers(s: store.Store) -> DataFrame:
    """Every stored row, so that a row that was added twice shows."""
    return s.billing["customers"].read().drop("updated_at", "ingested_at")


@query("rerun_batch")
def _(t):
    s, (everything, early) = _store(t, "rerun"), _customer_increments(t)
    for batch, records in ((1, early), (2, everything), (2, everything)):
        sync.sync_entity(s, "customers", records, batch, now=f"2024-02-0{batch} 00:00:00")
    return _stored_customers(s)


def _what_is_stored(s: store.Store, entity: str = "customers") -> DataFrame:
    """Rows of the raw, processed and audit tables: a key and how many rows it has, or how many records were synced."""
    raw = s.raw[entity].read().groupBy(c("id").alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    kept = s.billing[entity].read().groupBy(c(s.billing[entity].keys[0]).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    line = F.concat_ws(" ", "entity_type", F.date_format("sync_completed_at", "yyyy-MM-dd"), "status").alias("key")
    lines = s.history.read().select(line, c("records_synced").alias("rows"))
    named = {"raw": raw, "processed": kept, "audit": lines}
    parts = [rows.select(F.lit(name).alias("stored_in"), "key", "rows") for name, rows in named.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("rerun_after_compaction")
def _(t):
    """The second of two batches runs again after both were folded; the first reads the watermark of no batch."""
    s, (everything, early) = _store(t, "folded"), _customer_increments(t)
    for batch, records in ((1, early), (2, everything)):
        sync.sync_entity(s, "customers", records, batch, now=f"2024-02-0{batch} 00:00:00")
    sync.compact(s, after=1)
    sync.sync_entity(s, "customers", everything, 2, now="2024-02-02 00:00:00")
    return _what_is_stored(s)


class _Killed(BaseException):
    pass


@contextmanager
def _killed_after(writes: int) -> Iterator[None]:
    """Ends the work inside, as a lost driver would, right after so many writes to stored tables."""
    plain, done = Table._write, itertools.count(1)

    def write(self, *arguments):
        path = plain(self, *arguments)
        if next(done) == writes:
            raise _Killed
        return path

    Table._write = write
    try:
        yield
    except _Killed:
        pass
    finally:
        Table._write = plain


@query("killed_between_writes")
def _(t):
    """A batch is killed after each of its four writes in turn, then runs: what is stored before it runs, and after."""
    s, (everything, early) = _store(t, "killed"), _customer_increments(t)
    sync.sync_entity(s, "customers", early, 1, now="2024-02-01 00:00:00")
    for writes in (1, 2, 3, 4):
        with _killed_after(writes):
            sync.sync_entity(store.Store(t.spark, s.folder), "customers", everything, 2, now="2024-02-02 00:00:00")
    survivor = store.Store(t.spark, s.folder)
    before = _what_is_stored(survivor).withColumn("moment", F.lit("before"))
    sync.sync_entity(survivor, "customers", everything, 2, now="2024-02-02 00:00:00")
    return before.unionByName(_what_is_stored(survivor).withColumn("moment", F.lit("after")))


@query("read_as_of_version")
def _(t):
    """Rows of a table after each of its commits: two batches, a fold, and the first batch again."""
    rows, cut = t.b_invoices.select("invoice_id", "status", "created"), times.moment(CUT)
    table = _table(t, "versions", _ddl(rows))
    table.append(rows.where(c("created") < cut), 1)
    table.append(rows.where(c("created") >= cut), 2)
    table.compact()
    table.append(rows.where((c("created") < cut) & (c("status") == "paid")), 1)
    parts = [table.at(v).read().groupBy("status").agg(F.count(F.lit(1)).alias("rows")).withColumn("version", F.lit(v).cast("long")) for v in range(1, 5)]
    return reduce(DataFrame.unionByName, parts)


def _broken(t: Tables) -> DataFrame:
    return t.spark.range(1).select(F.lit("{broken").alias("json_data"))


@query("failed_then_retried")
def _(t):
    s, (everything, _early) = _store(t, "retried"), _customer_increments(t)
    for allowed in (0.0, 0.5):
        sync.sync_entity(s, "customers", everything.unionByName(_broken(t)), 1, now=SYNCED_AT, allowed_bad=allowed)
    return _stored_customers(s)


@query("old_bad_records")
def _(t):
    s, (everything, early) = _store(t, "old-bad"), _customer_increments(t)
    for batch, records, allowed in ((1, early, 0.5), (2, everything, 0.0)):
        sync.sync_entity(
            s, "customers", records.unionByName(_broken(t)), batch, now=f"2024-02-0{batch} 00:00:00", allowed_bad=allowed
        )
    return _stored_customers(s)


def _twice_read(t: Tables, label: str, fold: bool) -> store.Store:
    """Early customers, then all of them, the early ones once more, both times beside a record that cannot be read."""
    s, (everything, early) = _store(t, label), _customer_increments(t)
    for batch, records in ((1, early), (2, everything)):
        sync.sync_entity(
            s, "customers", records.unionByName(_broken(t)), batch, now=f"2024-02-0{batch} 00:00:00", lookback=10**10, allowed_bad=0.5
        )
    if fold:
        sync.compact(s, after=1)
    return s


@query("sync_metrics")
def _(t):
    """What was observed while each batch was written, after the batches were folded."""
    s = _twice_read(t, "metrics", fold=True)
    tables = {"raw": s.raw["customers"], "processed": s.billing["customers"], "unreadable": s.quarantine["customers"]}
    parts = [table.metrics().select(F.lit(name).alias("stored_in"), "batch", "rows", "newest") for name, table in tables.items()]
    return reduce(DataFrame.unionByName, parts)


@query("dq_freshness_observed")
def _(t):
    s = _twice_read(t, "freshness", fold=False)
    return quality.observed_freshness({"raw": s.raw["customers"], "processed": s.billing["customers"]}, FRESH_AS_OF)


@query("dq_raw_vs_processed_observed")
def _(t):
    """From the log alone, since all batches are folded."""
    s = _twice_read(t, "counts", fold=True)
    return quality.observed_raw_against_processed({"customers": (s.raw["customers"], s.billing["customers"])})


@query("late_records")
def _(t):
    s, (everything, _early) = _store(t, "late"), _customer_increments(t)
    created = F.get_json_object("json_data", "$.created").try_cast("bigint")
    sync.sync_entity(s, "customers", everything.where(created > CUT_SECONDS), 1, now="2024-02-01 00:00:00")
    sync.sync_entity(s, "customers", everything, 2, now="2024-02-02 00:00:00")
    return s.billing["customers"].current().select("customer_id", "created")


def _customer_files(t: Tables) -> tuple[str, list[DataFrame]]:
    """An empty landing folder, and the pages with the customers created up to the cut and with the later ones."""
    created = F.get_json_object("json_data", "$.created").try_cast("bigint")
    late = F.coalesce(created, F.lit(0)) > CUT_SECONDS
    records = landed.customer_records(t.b_customers)
    parts = [landed.pages(records.where(part), landed.key_number("customer_id")) for part in (~late, late)]
    return session.scratch(t.spark, "landing"), parts


def _files_read(s: store.Store) -> DataFrame:
    read = s.landed["customers"].read().groupBy("batch").agg(F.count(F.lit(1)).alias("rows"))
    return read.select(F.lit("files").alias("stored_in"), F.concat(F.lit("batch "), c("batch").cast("string")).alias("key"), "rows")


@query("sync_new_files")
def _(t):
    """Three syncs of a folder in which a file lands before the first and one before the second; each opens the new files only."""
    s, (path, parts) = _store(t, "new-files"), _customer_files(t)
    for batch, part in enumerate((*parts, None), start=1):
        if part is not None:
            part.coalesce(1).write.mode("append").json(path)
        sync.sync_entity(s, "customers", Landing(t.spark, path), batch, now=f"2024-02-0{batch} 00:00:00")
    return _what_is_stored(s).unionByName(_files_read(s))


@query("sync_late_files")
def _(t):
    """The later customers land first. The file with the earlier ones is read and skipped, and taken when a lookback reaches back to it."""
    s, (path, parts) = _store(t, "late-files"), _customer_files(t)
    for batch, part, lookback in ((1, parts[1], 0), (2, parts[0], 0), (3, None, 10**10)):
        if part is not None:
            part.coalesce(1).write.mode("append").json(path)
        sync.sync_entity(s, "customers", Landing(t.spark, path), batch, now=f"2024-02-0{batch} 00:00:00", lookback=lookback)
    return _what_is_stored(s).unionByName(_files_read(s))


def _land(t: Tables, body_pages: DataFrame, label: str) -> tuple[str, int]:
    """Pages that land in four parts, one after another, in the order of the pages' numbers, and the number of files in each part."""
    staged, path = session.scratch(t.spark, label), session.scratch(t.spark, label)
    body_pages.write.parquet(staged)
    pages_there = t.spark.read.parquet(staged)
    last = pages_there.agg(F.max("page")).first()[0] or 0
    rows = pages_there.withColumn("part", F.floor(c("page") * 4 / (last + 1)))
    sizes = {r["part"]: r["count"] for r in rows.groupBy("part").count().collect()}
    # As many in each part, so that a batch of the stream is a part; dealt in turn, none is empty.
    files = max(1, min(sizes.get(part, 0) for part in range(4)) // LANDED_PAGES)
    for part in range(4):
        rows.where(c("part") == part).drop("part").repartition(files).write.mode("append").json(path)
    return path, files


@query("stream_pages")
def _(t):
    path, files = _land(t, _customer_pages(t), "landing")
    table = _table(t, "streamed", "json_data string")
    feed.drain(feed.stream_pages(t.spark, path, files), session.scratch(t.spark, "progress"),
               feed.append_pages(table, lambda rows: rows.select("json_data")))
    return _flat_customers(table.read())


@query("stream_unreadable_pages")
def _(t):
    """What a stream of pages sets aside, beside the number of records it keeps."""
    path, files = _land(t, landed.pages(landed.tier_records(t.m_tiers), landed.key_number("product_id"), "any"), "landing")
    table, aside = _table(t, "streamed", "json_data string"), _table(t, "aside", "page bigint, body string, reason string")
    feed.drain(feed.stream_pages(t.spark, path, files), session.scratch(t.spark, "progress"),
               feed.append_pages(table, lambda rows: rows.select("json_data"), aside))
    kept = table.read().agg(F.count(F.lit(1))).scalar()
    return aside.read().select("page", "reason", kept.alias("kept"))


@query("stream_dedup")
def _(t):
    records = landed.subscription_records(t.b_subscriptions)
    path, files = _land(t, landed.pages(records, landed.key_number("subscription_id")), "landing")
    table = _table(t, "deduplicated", "customer_id string, page bigint, place int")
    rows = pages.list_or_envelope(feed.stream_pages(t.spark, path, files)).select(
        F.get_json_object("json_data", "$.customer").alias("customer_id"), "page", "place"
    )
    first = feed.first_arrivals(rows, ["customer_id"], ["page", "place"])
    feed.drain(first, session.scratch(t.spark, "progress"), feed.append_rows(table), changes=True)
    return table.read()


def _landed_feed(t: Tables) -> DataFrame:
    path = session.scratch(t.spark, "feed")
    _compressed(_linked(t)).json(path)
    return t.spark.read.schema("feed_kind int, feed_key string, json_data string").json(path)


@query("full_refresh_sync")
def _(t):
    s = _store(t, "refresh")
    sync.refresh_membership(s, landed.tier_records(t.m_tiers), _landed_feed(t), FEED_ORDER, 1, now=SYNCED_AT)
    counts = quality.row_counts({name: table.current() for name, table in s.membership.items()})
    return counts.select("table_name", "row_count")


@query("full_refresh_contents")
def _(t):
    """What a full refresh leaves in each table, as a key and a value of every row."""
    s = _store(t, "refresh")
    sync.refresh_membership(s, landed.tier_records(t.m_tiers), _landed_feed(t), FEED_ORDER, 1, now=SYNCED_AT)
    shown = {
        "tiers": ("product_id", "name"), "customers": ("client_id", "billing_id"), "sessions": ("session_id", "client_id"),
        "subscriptions": ("subscription_id", "status"), "assets": ("asset_id", "client_id"),
    }
    parts = [
        s.membership[name].current().select(F.lit(name).alias("table_name"), c(key).alias("key"), c(value).alias("value"))
        for name, (key, value) in shown.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("full_sync_contents")
def _(t):
    """What a whole run leaves in the two tables made for readers, and the contacts it sends."""
    s, sent = _store(t, "run"), session.scratch(t.spark, "sent")
    billing = {
        "customers": _landed(t, landed.customer_records(t.b_customers), "customers"),
        "subscriptions": _landed(t, landed.subscription_records(t.b_subscriptions), "subscriptions"),
    }
    sync.run_all(
        s, 1, billing, landed.tier_records(t.m_tiers), _landed_feed(t), FEED_ORDER, now=SYNCED_AT,
        send=lambda bodies: bodies.write.parquet(sent),
    )
    people = store.latest_version(t.spark, s.unified_path, s.log)
    snapshot_rows = store.latest_version(t.spark, s.snapshot_path, s.log)
    told = "struct<customers:array<struct<customer_id:string,product_id:string>>>"
    contact = t.spark.read.parquet(sent).select(F.explode(F.from_json("body", told)["customers"]).alias("x")).select("x.*")
    def shown(rows: DataFrame, name: str, key: str, value: str) -> DataFrame:
        return rows.select(F.lit(name).alias("table_name"), c(key).alias("key"), c(value).alias("value"))

    return reduce(DataFrame.unionByName, [
        shown(people, "unified_customers", "client_id", "billing_id"), shown(snapshot_rows, "bi_snapshot", "client_id", "customer_status"),
        shown(contact, "contacts", "customer_id", "product_id"),
    ])


@query("full_sync_run")
def _(t):
    s = _store(t, "run")
    billing = {
        "customers": _landed(t, landed.customer_records(t.b_customers), "customers"),
        "subscriptions": _landed(t, landed.subscription_records(t.b_subscriptions), "subscriptions"),
    }
    return sync.run_all(s, 1, billing, landed.tier_records(t.m_tiers), _landed_feed(t), FEED_ORDER, now=SYNCED_AT)


# -- end products --------------------------------------------------------------------------------


def _unified(t: Tables) -> DataFrame:
    return unified.unified_customers(
        t.m_customers, t.b_customers, t.b_subscriptions, t.m_subscriptions, t.m_tiers, t.m_assets, t.m_sessions,
        keep=lambda rows: session.stored(rows, session.scratch(t.spark, "items")),
    )


def _unified_flat(rows: DataFrame) -> DataFrame:
    """The record with each array shown as its length and its ids in order."""
    ids = {"billing_subscriptions": "subscription_id", "membership_subscriptions": "subscription_id",
           "assets": "asset_id", "sessions": "session_id"}
    scalars = [n for n in rows.columns if n not in unified.ARRAYS]
    lists = [F.array_join(c(a)[field], ",").alias(f"{a}_ids") for a, field in ids.items()]
    sizes = [F.size(a).cast("long").alias(f"{a}_count") for a in unified.ARRAYS]
    return rows.select(*scalars, *sizes, *lists, F.array_join("billing_product_ids", ",").alias("billing_product_list"))


def _snapshot(t: Tables) -> DataFrame:
    base = snapshot.bi_source(t.m_customers, t.b_customers, t.b_subscriptions, t.m_subscriptions, t.m_tiers)
    return snapshot.bi_snapshot(
        base, t.b_subscriptions, t.m_subscriptions, t.m_assets, t.m_sessions, times.moment(SYNCED_AT)
    )


def _snapshot_flat(rows: DataFrame) -> DataFrame:
    return rows.withColumn("billing_product_ids", F.array_join("billing_product_ids", ","))


@query("unified_customers")
def _(t):
    return _unified_flat(_unified(t))


@query("bi_customer_360_snapshot")
def _(t):
    return _snapshot_flat(_snapshot(t))


@query("unified_counts")
def _(t):
    children = unified.all_children(t.b_subscriptions, t.m_subscriptions, t.m_tiers, t.m_assets, t.m_sessions)
    return unified.with_counts(_people(t).select("client_id", "billing_id", "email", "full_name"), children)


@query("delinquent_customers")
def _(t):
    return customers.delinquent(t.b_customers)


@query("recent_customers")
def _(t):
    return customers.recent(t.b_customers, RECENT_AS_OF)


@query("subs_ending_soon")
def _(t):
    return revenue.ending_soon(t.b_subscriptions, ENDING_AS_OF)


@query("overdue_invoices")
def _(t):
    return invoices.overdue(t.b_invoices, INVOICE_AS_OF)


@query("failed_syncs")
def _(t):
    return sync_reports.failed_syncs(t.sync_history)


@query("failed_syncs_all")
def _(t):
    return sync_reports.failed_syncs(t.sync_history, limit=None)


@query("recent_sync_log")
def _(t):
    return sync_reports.recent_sync_log(t.sync_history)


@query("customer_growth")
def _(t):
    return customers.growth(t.b_customers)


@query("customers_by_country")
def _(t):
    return customers.by_country(t.b_customers)


@query("revenue_cohorts")
def _(t):
    return invoices.revenue_cohorts(t.b_customers, t.b_invoices)


@query("renewal_rate")
def _(t):
    return revenue.renewal_rate(t.b_subscriptions)
