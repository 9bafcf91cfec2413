"""Subscription-business tables derived from the star-schema test tables.

Each view keeps every row of its base table; gaps (customers without e-mail, members without a
billing link, unknown products) come from values that are null or unknown. The text is plain SQL
with one dialect-dependent spot, `{json_k}`, so an oracle can use the same definitions.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, str] = {
    "b_customers": """
        SELECT 'cus_' || cast(c.c_custkey AS string) AS customer_id,
               'customer' AS object_type,
               CASE c.c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN ''
                    ELSE 'u' || cast(c.c_custkey AS string) || '@x.test' END AS email,
               CASE WHEN c.c_custkey % 13 <> 0 THEN c.c_name END AS name,
               c.c_mktsegment || ' account' AS description,
               CASE WHEN c.c_custkey % 3 <> 0 THEN '+1' || cast(c.c_custkey AS string) END AS phone,
               f.first_order AS created,
               cast(c.c_custkey AS string) || ' Main St' AS address_line1,
               CASE WHEN c.c_custkey % 4 = 0 THEN 'Unit ' || cast(c.c_custkey % 9 AS string) END AS address_line2,
               'City ' || cast(n.n_regionkey AS string) AS address_city,
               'ST' || cast(n.n_nationkey AS string) AS address_state,
               cast(10000 + c.c_custkey % 9000 AS string) AS address_postal_code,
               CASE WHEN c.c_custkey % 11 <> 0 THEN n.n_name END AS address_country,
               lower(c.c_mktsegment) AS currency,
               cast(round(c.c_acctbal * 100) AS bigint) AS balance,
               c.c_acctbal < 0 AS delinquent,
               CASE WHEN c.c_custkey % 5 < 3 THEN 'pm_' || cast(c.c_custkey AS string) END AS default_source,
               'INV' || cast(c.c_custkey AS string) AS invoice_prefix,
               f.first_order AS updated_at,
               f.first_order + interval '2' hour AS ingested_at
        FROM {customer} c
        LEFT JOIN {nation} n ON n.n_nationkey = c.c_nationkey
        LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM {orders} GROUP BY o_custkey) f
          ON f.o_custkey = c.c_custkey""",
    "b_subscriptions": """
        SELECT 'sub_' || cast(o_orderkey AS string) AS subscription_id,
               'subscription' AS object_type,
               CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'O' THEN 'past_due' ELSE 'canceled' END AS status,
               o_orderdate AS created,
               o_orderdate AS current_period_start,
               o_orderdate + interval '30' day AS current_period_end,
               o_orderkey % 5 = 0 AS cancel_at_period_end,
               CASE WHEN o_orderstatus = 'P'
                    THEN o_orderdate + interval '1' day * cast(o_orderkey % 200 AS int) + interval '7' hour
               END AS canceled_at,
               CASE WHEN o_orderstatus = 'P'
                    THEN o_orderdate + interval '1' day * cast(o_orderkey % 200 AS int) + interval '8' hour
               END AS ended_at,
               'cus_' || cast(o_custkey AS string) AS customer_id,
               'usd' AS currency,
               cast(round(o_totalprice * 100) AS bigint) AS amount_cents,
               CASE WHEN o_orderkey % 4 = 0 THEN 'year' ELSE 'month' END AS subscription_interval,
               cast(1 AS bigint) AS interval_count,
               o_orderpriority AS plan_name,
               'price_' || cast(o_orderkey % 60 AS string) AS plan_id,
               CASE WHEN o_orderkey % 13 <> 0 THEN 'prod_' || cast(o_orderkey % 40 AS string) END AS product_id,
               CASE WHEN o_orderkey % 3 = 0 THEN 'send_invoice' ELSE 'charge_automatically' END AS collection_method,
               o_orderdate AS updated_at,
               o_orderdate + interval '1' hour AS ingested_at
        FROM {orders}""",
    "b_invoices": """
        SELECT 'in_' || cast(l.l_orderkey AS string) || '_' || cast(l.l_linenumber AS string) AS invoice_id,
               'N-' || cast(l.l_orderkey AS string) || '-' || cast(l.l_linenumber AS string) AS number,
               'cus_' || cast(o.o_custkey AS string) AS customer_id,
               'u' || cast(o.o_custkey AS string) || '@x.test' AS customer_email,
               CASE WHEN l.l_linestatus = 'F' THEN 'paid' WHEN l.l_returnflag = 'R' THEN 'void' ELSE 'open' END AS status,
               'usd' AS currency,
               l.l_shipdate AS created,
               CASE WHEN l.l_partkey % 17 <> 0 THEN l.l_shipdate + interval '30' day END AS due_date,
               l.l_shipdate + interval '3' hour AS ingested_at,
               cast(round(l.l_extendedprice * 100) AS bigint) AS amount_due,
               CASE WHEN l.l_linestatus = 'F' THEN cast(round(l.l_extendedprice * 100) AS bigint)
                    ELSE cast(0 AS bigint) END AS amount_paid,
               CASE WHEN l.l_linestatus = 'F' THEN cast(0 AS bigint)
                    ELSE cast(round(l.l_extendedprice * 100) AS bigint) END AS amount_remaining,
               cast(round(l.l_extendedprice * 100) AS bigint) AS total,
               l.l_linestatus = 'F' AS paid,
               l.l_returnflag <> 'N' AS attempted
        FROM {lineitem} l LEFT JOIN {orders} o ON o.o_orderkey = l.l_orderkey""",
    "m_customers": """
        SELECT 'cl_' || cast(c_custkey AS string) AS client_id,
               CASE WHEN c_custkey % 10 <> 0 THEN 'cus_' || cast(c_custkey AS string) END AS billing_id,
               CASE WHEN c_custkey % 9 <> 0 THEN 'm' || cast(c_custkey AS string) || '@y.test' END AS email,
               CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS first_name,
               CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END AS last_name,
               CASE WHEN c_custkey % 8 <> 0 THEN '+9' || cast(c_custkey AS string) END AS phone_number,
               cast('2020-01-01 00:00:00' AS timestamp) + interval '1' day * cast(c_custkey % 1000 AS int)
                 AS customer_created_date,
               cast('2024-02-01 00:00:00' AS timestamp) AS updated_at,
               cast('2024-02-01 01:00:00' AS timestamp) AS ingested_at
        FROM {customer}""",
    "m_subscriptions": """
        SELECT 'ms_' || cast(l.l_orderkey AS string) || '_' || cast(l.l_linenumber AS string)
                 || '_' || cast(l.l_partkey AS string) AS subscription_id,
               'cl_' || cast(o.o_custkey AS string) AS client_id,
               CASE WHEN o.o_custkey % 10 <> 0 THEN 'cus_' || cast(o.o_custkey AS string) END AS billing_id,
               CASE l.l_returnflag WHEN 'R' THEN 'active' WHEN 'A' THEN 'canceled' ELSE 'paused' END AS status,
               CASE WHEN l.l_quantity > 45 THEN 'gone_' ELSE 'prod_' END || cast(l.l_partkey AS string) AS product_id,
               '["asset_' || cast(l.l_partkey AS string) || '"]' AS asset_ids,
               l.l_shipdate AS updated_at,
               l.l_shipdate + interval '1' day AS ingested_at
        FROM {lineitem} l LEFT JOIN {orders} o ON o.o_orderkey = l.l_orderkey""",
    "m_tiers": """
        SELECT 'prod_' || cast(p_partkey AS string) AS product_id,
               p_name AS name,
               p_name || ' plan' AS description,
               p_brand AS product_key,
               cast(p_size AS string) AS metadata_order,
               p_type AS perks,
               CASE WHEN p_partkey % 3 = 0 THEN 'true' ELSE 'false' END AS refund_required,
               CASE WHEN p_partkey % 5 = 0 THEN 'none' END AS external_api_integration,
               CASE WHEN p_partkey % 6 = 0 THEN 'max:' || cast(p_size AS string) END AS validation_rules,
               CASE WHEN p_partkey % 6 = 0 THEN 'at most ' || cast(p_size AS string) END AS validation_description,
               cast(cast(round(p_retailprice * 100) AS bigint) AS string) AS taxable_amount
        FROM {part}""",
    "m_sessions": """
        SELECT cast(event_id AS string) AS session_id,
               'cl_' || cast(user_id AS string) AS client_id,
               ts AS session_date,
               event_type AS session_type,
               event_type || ' visit' AS session_description,
               {json_k} AS location_id,
               'Bay ' || {json_k} AS location_name,
               event_id % 4 <> 0 AS location_is_active,
               ts AS updated_at,
               ts + interval '1' hour AS ingested_at
        FROM {events}""",
    "m_assets": """
        SELECT 'asset_' || cast(a.partkey AS string) AS asset_id,
               'cl_' || cast(a.custkey AS string) AS client_id,
               CASE WHEN a.custkey % 10 <> 0 THEN 'cus_' || cast(a.custkey AS string) END AS billing_id,
               p.p_brand AS make,
               p.p_name AS model,
               cast(1970 + p.p_size AS bigint) AS year,
               'PL-' || cast(a.partkey AS string) AS license_plate,
               p.p_type AS color,
               'VIN' || cast(a.custkey AS string) || '-' || cast(a.partkey AS string) AS vin,
               a.updated_at AS updated_at,
               a.updated_at + interval '1' day AS ingested_at
        FROM (SELECT o.o_custkey AS custkey, l.l_partkey AS partkey, max(l.l_shipdate) AS updated_at
              FROM {lineitem} l LEFT JOIN {orders} o ON o.o_orderkey = l.l_orderkey
              GROUP BY o.o_custkey, l.l_partkey) a
        LEFT JOIN {part} p ON p.p_partkey = a.partkey""",
    "sync_history": """
        SELECT event_type AS entity_type,
               ts - interval '1' hour AS last_sync_timestamp,
               cast(NULL AS string) AS last_synced_id,
               cast(floor(value) AS bigint) AS records_synced,
               ts - interval '5' minute AS sync_started_at,
               CASE WHEN event_id % 97 <> 0 THEN ts END AS sync_completed_at,
               CASE WHEN event_id % 10 = 0 THEN 'failed' ELSE 'success' END AS status,
               CASE WHEN event_id % 10 = 0 THEN 'error ' || cast(event_id AS string) END AS error_message
        FROM {events}""",
}

BASE_TABLES = ("customer", "nation", "orders", "lineitem", "part", "events")

_SPARK_DIALECT = (
    ("{json_k}", "get_json_object(props, '$.k')"),
    ("AS timestamp)", "AS timestamp_ntz)"),
)


class Tables:
    """The views over one data folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._bases: dict[str, DataFrame] = {}

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    @property
    def paths(self) -> list[str]:
        return [self._path(name) for name in BASE_TABLES]

    def base(self, name: str) -> DataFrame:
        if name not in self._bases:
            self._bases[name] = self.spark.read.parquet(self._path(name))
        return self._bases[name]

    def view(self, name: str) -> DataFrame:
        text = VIEWS[name]
        for generic, own in _SPARK_DIALECT:
            text = text.replace(generic, own)
        needed = [t for t in BASE_TABLES if re.search(r"\{%s\}" % t, text)]
        return self.spark.sql(text, **{t: self.base(t) for t in needed})

    @cached_property
    def b_customers(self) -> DataFrame:
        return self.view("b_customers")

    @cached_property
    def b_subscriptions(self) -> DataFrame:
        return self.view("b_subscriptions")

    @cached_property
    def b_invoices(self) -> DataFrame:
        return self.view("b_invoices")

    @cached_property
    def b_invoice_amounts(self) -> DataFrame:
        """Invoices without their customer: the same rows, without the join that finds it."""
        text = VIEWS["b_invoices"].replace("LEFT JOIN {orders} o ON o.o_orderkey = l.l_orderkey", "")
        lines = [line for line in text.splitlines() if "o.o_custkey" not in line]
        return self.spark.sql("\n".join(lines), lineitem=self.base("lineitem"))

    @cached_property
    def m_customers(self) -> DataFrame:
        return self.view("m_customers")

    @cached_property
    def m_subscriptions(self) -> DataFrame:
        return self.view("m_subscriptions")

    @cached_property
    def m_tiers(self) -> DataFrame:
        return self.view("m_tiers")

    @cached_property
    def m_sessions(self) -> DataFrame:
        return self.view("m_sessions")

    @cached_property
    def m_assets(self) -> DataFrame:
        return self.view("m_assets")

    @cached_property
    def sync_history(self) -> DataFrame:
        return self.view("sync_history")
