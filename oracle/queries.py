"""The expected result of each registered query as plain SQL over the given tables.

The SQL is written the direct way (ranked windows, plain joins, string aggregates), where the
engine uses aggregates and paged arrays. Only the definitions of the test views are shared.
"""

from __future__ import annotations

import re

from tallyloom.sources.fixtures import BASE_TABLES, VIEWS


def _view(name: str) -> str:
    text = VIEWS[name].replace("{json_k}", "json_extract_string(props, '$.k')")
    for table in BASE_TABLES:
        text = text.replace("{%s}" % table, table)
    return f"{name} AS ({text})"


def over_views(body: str, ctes: str = "") -> str:
    used = [name for name in VIEWS if re.search(rf"\b{name}\b", body + ctes)]
    parts = [_view(name) for name in used] + ([ctes] if ctes else [])
    return (f"WITH {', '.join(parts)} " if parts else "") + body


ORACLE: dict[str, str] = {}


def add(name: str, body: str, ctes: str = "") -> None:
    ORACLE[name] = over_views(body, ctes)


EPOCH_S = "cast(floor(epoch({0})) AS bigint)"
ADDRESS = "address_line1, address_line2, address_city, address_state, address_postal_code, address_country"

FLAT_CUSTOMERS = f"""
SELECT customer_id, object_type, email, name, description, phone,
       coalesce(created, timestamp '1970-01-01 00:00:00') AS created,
       coalesce({EPOCH_S.format('created')}, 0) AS created_timestamp, {ADDRESS},
       currency, balance, delinquent, default_source, invoice_prefix
FROM b_customers"""

FLAT_TIERS = """
SELECT product_id, name, description, product_key, metadata_order, perks, refund_required,
       external_api_integration, validation_rules, validation_description, taxable_amount
FROM m_tiers"""

# -- sources
for _name in ("scan_page_envelopes", "flatten_customers", "incremental_sync", "stream_pages", "rerun_batch",
              "failed_then_retried", "old_bad_records"):
    add(_name, FLAT_CUSTOMERS)
add("scan_list_or_envelope", """
SELECT product_id AS id, cast(split_part(product_id, '_', 2) AS bigint) // 100 + 1 AS page FROM m_tiers
WHERE (cast(split_part(product_id, '_', 2) AS bigint) // 100 + 1) % 3 <> 2""")
add("scan_unreadable_pages", """
SELECT DISTINCT cast(split_part(product_id, '_', 2) AS bigint) // 100 + 1 AS page, 'no list of records' AS reason FROM m_tiers
WHERE (cast(split_part(product_id, '_', 2) AS bigint) // 100 + 1) % 3 = 2""")
add("scan_incremental", "SELECT customer_id, name, created FROM b_customers WHERE created > timestamp '1997-01-01'")
add("scan_bounded", """
SELECT subscription_id, customer_id, created, amount_cents FROM b_subscriptions ORDER BY created, subscription_id LIMIT 100""")
for _name in ("scan_tier_pages", "flatten_tiers"):
    add(_name, FLAT_TIERS)
LAST_SESSION = """last_session AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY session_date DESC, session_id DESC) AS rn FROM m_sessions
) r WHERE rn = 1)"""
add("scan_cursor_pages", """
SELECT m.client_id, m.billing_id, m.email, s.session_id FROM m_customers m LEFT JOIN last_session s USING (client_id)""",
    LAST_SESSION)
add("scan_by_id", """
SELECT m.billing_id AS customer_id, b.email, b.balance FROM m_customers m
LEFT JOIN b_customers b ON b.customer_id = m.billing_id WHERE m.billing_id IS NOT NULL""")
add("scan_children_of", """
SELECT s.customer_id, s.subscription_id, s.status, s.product_id FROM b_subscriptions s
WHERE s.customer_id IN (SELECT customer_id FROM b_customers WHERE delinquent)""")
add("scan_id_sections", """
SELECT id FROM first_part UNION ALL
SELECT customer_id FROM (SELECT customer_id, row_number() OVER (ORDER BY cast(split_part(customer_id, '_', 2) AS bigint)) AS n
  FROM b_customers WHERE phone IS NULL) x WHERE n <= 200 - (SELECT count(*) FROM first_part)""",
    """first_part AS (SELECT customer_id AS id FROM b_customers WHERE phone IS NOT NULL
ORDER BY cast(split_part(customer_id, '_', 2) AS bigint) LIMIT 100)""")
add("scan_table", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders")
add("scan_last_sync", f"""
SELECT entity_type, {EPOCH_S.format('last_sync_timestamp')} AS last_sync_timestamp, last_synced_id, records_synced, status
FROM sync_history WHERE entity_type = 'click'
ORDER BY sync_completed_at DESC NULLS LAST, sync_started_at DESC LIMIT 1""")

# -- sinks
add("sink_raw_append", """
SELECT subscription_id AS id, timestamp '2024-02-02 00:00:00' AS ingested_at, created, cast(date_trunc('month', created) AS date) AS created_month, status
FROM b_subscriptions""")
add("sink_raw_tiers", "SELECT product_id AS id, timestamp '2024-02-02 00:00:00' AS ingested_at, name FROM m_tiers")
add("sink_raw_mixed", """
SELECT client_id AS id, 'customer' AS record_type, timestamp '2024-02-02 00:00:00' AS ingested_at FROM m_customers
UNION ALL SELECT client_id, 'customer', timestamp '2024-02-02 00:00:00' FROM m_subscriptions
UNION ALL SELECT client_id, 'session', timestamp '2024-02-02 00:00:00' FROM m_sessions""")
add("sink_raw_linked", """
SELECT client_id AS id, timestamp '2024-02-02 00:00:00' AS ingested_at FROM m_customers
UNION ALL SELECT client_id, timestamp '2024-02-02 00:00:00' FROM m_subscriptions""")
add("upsert_latest", """
SELECT invoice_id, number, customer_id, customer_email, status, currency, created, due_date, ingested_at, amount_due,
       amount_paid, amount_remaining, total, paid, attempted
FROM (SELECT *, row_number() OVER (PARTITION BY invoice_id ORDER BY ingested_at DESC, number DESC, customer_id DESC,
        customer_email DESC, status DESC, currency DESC, created DESC, due_date DESC NULLS LAST, amount_due DESC,
        amount_paid DESC, amount_remaining DESC, total DESC, paid DESC, attempted DESC) AS rn FROM b_invoices) r
WHERE rn = 1""")
add("sink_full_refresh", "SELECT client_id, billing_id, email FROM m_customers")
add("create_views", """
SELECT cast(date_trunc('month', current_period_start) AS date) AS month, cast(sum(amount_cents) AS bigint) / 100 AS mrr,
       count(*) AS subscription_count
FROM b_subscriptions WHERE status = 'active' GROUP BY 1""")
ORACLE["mrr_by_month"] = ORACLE["create_views"]
HISTORY = "entity_type, last_sync_timestamp, records_synced, sync_started_at, sync_completed_at, status, error_message"
add("seed_merge_not_matched", f"""
SELECT {HISTORY} FROM sync_history
UNION ALL SELECT e, timestamp '1970-01-01 00:00:00', 0, NULL, NULL, 'pending', NULL
FROM (VALUES ('customers'), ('subscriptions'), ('click')) v(e)
WHERE e NOT IN (SELECT entity_type FROM sync_history)""")
add("append_sync_history", f"""
SELECT {HISTORY} FROM sync_history
UNION ALL SELECT 'customers', timestamp '1997-01-01 00:00:00', 5, timestamp '2024-02-02 00:00:00',
                 timestamp '2024-02-02 00:00:00', 'success', NULL
UNION ALL SELECT 'tiers', NULL, 7, timestamp '2024-02-02 00:00:00', timestamp '2024-02-02 00:00:00', 'failed', 'no answer'""")
add("ensure_tables", f"SELECT {HISTORY}, cast(sync_completed_at AS date) AS completed_date FROM sync_history")
add("ensure_database", """
SELECT 'dropped' AS moment, 'm_assets' AS table_name, false AS is_there, cast(NULL AS bigint) AS row_count
UNION ALL SELECT 'dropped', 'm_tiers', true, count(*) FROM m_tiers
UNION ALL SELECT 'ensured', 'm_tiers', true, count(*) FROM m_tiers
UNION ALL SELECT 'ensured', 'm_sessions', true, count(*) FROM m_sessions
UNION ALL SELECT 'ensured', 'sync_history', true, count(*) FROM sync_history
UNION ALL SELECT 'ensured', 'b_refunds', false, NULL
UNION ALL SELECT 'ensured', x, true, 0 FROM unnest(['raw_billing_customers', 'raw_billing_subscriptions', 'raw_tiers', 'raw_mixed',
  'raw_linked_customers', 'b_customers', 'b_subscriptions', 'm_customers', 'm_subscriptions', 'm_assets']) u(x)""")
add("drop_legacy", """
SELECT count(*) AS tiers, (SELECT count(*) FROM m_customers) + (SELECT count(*) FROM m_sessions) AS staged_rows,
       2 AS tables_before, 0 AS tables_after FROM m_tiers""")

EXPORT = """
SELECT s.subscription_id, s.object_type, s.status, strftime(s.created, '%Y-%m-%d %H:%M:%S') AS created,
  cast(epoch(s.created) AS bigint) AS created_timestamp,
  strftime(s.current_period_start, '%Y-%m-%d %H:%M:%S') AS current_period_start,
  strftime(s.current_period_end, '%Y-%m-%d %H:%M:%S') AS current_period_end,
  s.customer_id, coalesce(c.email, '') AS customer_email,
  coalesce(CASE WHEN c.name <> '' THEN c.name END, c.description, '') AS customer_name,
  CASE WHEN c.address_country IS NOT NULL THEN c.address_country
       WHEN c.default_source IS NOT NULL THEN 'PM ' || c.address_state ELSE '' END AS customer_country,
  CASE WHEN c.address_country IS NULL AND c.default_source IS NOT NULL THEN '00000'
       ELSE c.address_postal_code END AS customer_postal_code,
  s.currency, s.amount_cents / 100 AS amount, s.subscription_interval AS "interval",
  CASE WHEN s.subscription_interval = 'year' THEN coalesce(s.product_id, '') ELSE s.plan_name END AS plan_name
FROM b_subscriptions s LEFT JOIN b_customers c ON c.customer_id = s.customer_id"""
add("export_subscriptions", EXPORT)
add("extract_subscription_rows", EXPORT)
add("export_customers", f"SELECT * EXCLUDE (subscription_id) FROM ({EXPORT}) x")
add("extract_customer_rows", f"""
SELECT * EXCLUDE (subscription_id) FROM ({EXPORT}) x""")

PRODUCTS = """products AS (
SELECT subscription_id, customer_id, created, cast(0 AS bigint) AS place, product_id FROM b_subscriptions
WHERE product_id IS NOT NULL
UNION ALL SELECT subscription_id, customer_id, created, 1, 'addon' FROM b_subscriptions WHERE subscription_interval = 'year')"""
CONTACTS = PRODUCTS + """, people AS (
SELECT customer_id, nullif(email, '') AS email, name, phone FROM b_customers
WHERE nullif(email, '') IS NOT NULL OR name IS NOT NULL OR phone IS NOT NULL),
contacts AS (SELECT p.customer_id, p.email, p.name, p.phone, d.product_id FROM people p
LEFT JOIN (SELECT DISTINCT customer_id, product_id FROM products) d ON d.customer_id = p.customer_id)"""
NUMBERED = CONTACTS + """, numbered AS (
SELECT *, row_number() OVER (ORDER BY customer_id, product_id NULLS FIRST) AS contact_no FROM contacts)"""
add("product_ids_of_subscription", "SELECT subscription_id, customer_id, place, product_id FROM products", PRODUCTS)
add("sink_contact_batches", """
SELECT contact_no, (contact_no - 1) // 1000 AS chunk, customer_id, product_id FROM numbered""", NUMBERED)
add("contact_bodies", """
SELECT (contact_no - 1) // 1000 AS chunk, count(*) AS contacts, 'new' AS tag,
       arg_min(customer_id, contact_no) AS first_customer FROM numbered GROUP BY 1""", NUMBERED)
add("contact_payloads", """
SELECT customer_id, product_id, email, name, phone,
  1 + (product_id IS NOT NULL)::bigint + (email IS NOT NULL)::bigint + (name IS NOT NULL)::bigint
    + (phone IS NOT NULL)::bigint AS fields FROM contacts""", CONTACTS)
add("quarantine_bad_records", """
SELECT customer_id, CASE WHEN delinquent THEN 'not readable' WHEN name IS NULL THEN 'no id' ELSE 'kept' END AS outcome
FROM b_customers""")

# -- projections
add("flatten_subscriptions", """
SELECT subscription_id, object_type, status, created, cast(epoch(created) AS bigint) AS created_timestamp,
  current_period_start, current_period_end, cancel_at_period_end, canceled_at, ended_at, customer_id, currency,
  nullif(amount_cents, 0) AS amount_cents, subscription_interval, interval_count,
  CASE WHEN subscription_interval = 'year' THEN product_id ELSE plan_name END AS plan_name, plan_id, product_id,
  collection_method FROM b_subscriptions""")
MEMBER_FIELDS = "client_id, billing_id, email, first_name, last_name, phone_number, customer_created_date"
add("split_linked_customers", f"SELECT {MEMBER_FIELDS} FROM m_customers")
add("split_mixed_customers", f"""
SELECT {MEMBER_FIELDS} FROM m_customers
UNION ALL SELECT DISTINCT client_id, NULL, NULL, NULL, NULL, NULL, NULL::timestamp FROM m_sessions
WHERE client_id NOT IN (SELECT client_id FROM m_customers WHERE billing_id IS NULL)""")
for _name in ("split_linked_subscriptions", "split_mixed_subscriptions"):
    add(_name, """SELECT subscription_id, client_id, billing_id, status, product_id,
json_extract_string(asset_ids, '$[0]') AS asset_ids FROM m_subscriptions""")
add("split_mixed_sessions", """
SELECT session_id, client_id, session_date, session_type, session_description, location_id, location_name,
       location_is_active FROM m_sessions""")
add("split_linked_sessions", """
SELECT s.session_id, client_id, s.session_date, s.session_type, s.session_description,
       cast(NULL AS varchar) AS location_id, s.location_name, cast(NULL AS boolean) AS location_is_active
FROM m_customers JOIN last_session s USING (client_id)""", LAST_SESSION)
ASSETS_OF_FEED = """
SELECT json_extract_string(asset_ids, '$[0]') AS asset_id, client_id, billing_id, status AS make, product_id AS model,
       {year} AS year, subscription_id AS license_plate, cast(NULL AS varchar) AS color, cast(NULL AS varchar) AS vin
FROM m_subscriptions"""
add("split_mixed_assets", ASSETS_OF_FEED.format(year="cast(NULL AS bigint)"))
add("split_linked_assets", ASSETS_OF_FEED.format(year="cast(0 AS bigint)"))
add("classify_raw_record", """
SELECT n AS feed_row, coalesce(id, 'row_' || cast(n - 1 AS varchar)) AS id, record_type FROM (
  SELECT id, record_type, row_number() OVER (ORDER BY kind, key, happened, id NULLS FIRST) AS n FROM (
    SELECT 0 AS kind, subscription_id AS key, updated_at AS happened, CASE WHEN status <> 'paused' THEN client_id END AS id,
           'customer' AS record_type FROM m_subscriptions
    UNION ALL SELECT 1, session_id, session_date, CASE WHEN session_type = 'click' THEN client_id ELSE session_id END,
           'session' FROM m_sessions) x) y""")
add("full_name", "SELECT client_id, trim(coalesce(first_name, '') || ' ' || coalesce(last_name, '')) AS full_name FROM m_customers")
LAST_MEMBER = """last_member AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY billing_id ORDER BY updated_at DESC, subscription_id DESC, client_id DESC,
    product_id DESC, status DESC) AS rn FROM m_subscriptions WHERE billing_id IS NOT NULL) r WHERE rn = 1)"""
add("match_display_fields", """
SELECT billing_id, coalesce(c.name, trim(' ' || m.status)) AS display_name,
       coalesce(nullif(c.email, ''), m.product_id, '') AS display_email
FROM b_customers c JOIN last_member m ON m.billing_id = c.customer_id""", LAST_MEMBER)
LATEST_BILLING = """latest_billing AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY CASE WHEN status = 'active' THEN 0 ELSE 1 END,
    created DESC, subscription_id DESC) AS rn FROM b_subscriptions WHERE customer_id IS NOT NULL) r WHERE rn = 1)"""
STATUS = """CASE {0} WHEN 'active' THEN 'Active' WHEN 'past_due' THEN 'Past Due' WHEN 'canceled' THEN 'Churned'
ELSE 'No Subscription' END"""
add("customer_status", f"""
SELECT customer_id, {STATUS.format('l.status')} AS customer_status FROM b_customers LEFT JOIN latest_billing l USING (customer_id)""",
    LATEST_BILLING)
RENEWAL = """CASE WHEN status = 'active' THEN CASE WHEN cancel_at_period_end THEN 'will_cancel' ELSE 'will_renew' END
WHEN status = 'canceled' THEN 'canceled' ELSE 'other' END"""
add("renewal_status", f"SELECT subscription_id, {RENEWAL} AS renewal_status FROM b_subscriptions")
LATEST_MEMBERSHIP = """latest_membership AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY billing_id ORDER BY CASE WHEN status = 'active' THEN 0 ELSE 1 END,
    updated_at DESC, subscription_id DESC, status DESC, product_id DESC) AS rn
  FROM m_subscriptions WHERE billing_id IS NOT NULL) r WHERE rn = 1)"""
TIER = LATEST_MEMBERSHIP + """, tier AS (
SELECT l.billing_id, t.product_id AS current_tier_product_id, t.name AS current_tier_name,
       t.product_key AS current_tier_key, t.perks AS current_tier_perks
FROM latest_membership l LEFT JOIN m_tiers t ON t.product_id = l.product_id)"""
SCALARS = """
m.client_id, m.billing_id, m.email, m.first_name, m.last_name,
trim(coalesce(m.first_name, '') || ' ' || coalesce(m.last_name, '')) AS full_name, m.phone_number,
m.customer_created_date AS membership_since, m.updated_at AS membership_updated_at,
m.ingested_at AS membership_ingested_at, b.customer_id AS billing_customer_id, b.created AS billing_customer_since,
b.currency AS billing_currency, b.email AS billing_email, b.name AS billing_name,
b.description AS billing_description, b.phone AS billing_phone, b.address_line1, b.address_line2, b.address_city,
b.address_state, b.address_postal_code, b.address_country, t.current_tier_product_id, t.current_tier_name,
t.current_tier_key, t.current_tier_perks"""
BOTH = """FROM m_customers m JOIN b_customers b ON b.customer_id = m.billing_id
LEFT JOIN tier t ON t.billing_id = m.billing_id"""
add("unified_projection", f"SELECT {SCALARS} {BOTH}", TIER)
PROBE = """probe AS (SELECT customer_id,
  CASE WHEN customer_id NOT IN (SELECT billing_id FROM m_customers WHERE billing_id IS NOT NULL) THEN 'error'
       WHEN (SELECT count(*) FROM m_subscriptions s WHERE s.billing_id = c.customer_id) > 0 THEN 'with_data'
       ELSE 'empty' END AS outcome,
  (SELECT count(*) FROM m_subscriptions s WHERE s.billing_id = c.customer_id) AS memberships FROM b_customers c)"""
add("membership_probe_classes", "SELECT customer_id, outcome, memberships FROM probe", PROBE)
add("membership_probe_summary", """
SELECT count(*) AS total_tested, count(*) FILTER (outcome = 'with_data') AS with_data,
  count(*) FILTER (outcome = 'empty') AS without_data, count(*) FILTER (outcome = 'error') AS errors FROM probe""", PROBE)

# -- filters
add("filter_status_eq", "SELECT subscription_id, customer_id FROM b_subscriptions WHERE status = 'active'")
add("filter_not_null", "SELECT customer_id, address_country FROM b_customers WHERE address_country IS NOT NULL")
add("filter_bool", "SELECT invoice_id, created, amount_due FROM b_invoices WHERE attempted AND NOT paid")
add("filter_last_n", """
SELECT entity_type, sync_completed_at, status FROM sync_history
WHERE sync_completed_at >= timestamp '2024-01-31' - interval '30' day""")
add("filter_between_next_n", """
SELECT subscription_id, current_period_end FROM b_subscriptions
WHERE current_period_end BETWEEN timestamp '2001-07-01' AND timestamp '2001-07-08'""")
add("filter_overdue", """
SELECT invoice_id, due_date, amount_remaining FROM b_invoices
WHERE status <> 'paid' AND due_date < timestamp '2001-08-01' AND amount_remaining > 0""")
add("filter_array_non_empty", """
SELECT m.client_id, s.n AS session_count
FROM m_customers m JOIN b_customers b ON b.customer_id = m.billing_id
JOIN (SELECT client_id, count(*) AS n FROM m_sessions GROUP BY client_id) s ON s.client_id = m.client_id""")
add("filter_param", "SELECT entity_type, sync_completed_at, status FROM sync_history WHERE entity_type = 'purchase'")
add("filter_any_identity", """
SELECT * FROM (SELECT CASE WHEN email IS NOT NULL THEN client_id ELSE '' END AS client_id, billing_id, email FROM m_customers) x
WHERE client_id <> '' OR billing_id <> '' OR email <> ''""")
add("filter_any_contact", """
SELECT customer_id, email, phone, name FROM b_customers WHERE email <> '' OR phone <> '' OR name <> ''""")
add("filter_rank_one", """
SELECT customer_id, created, subscription_id, status FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY created DESC, subscription_id DESC) AS rn
  FROM b_subscriptions) r WHERE rn = 1""")

# -- joins
add("cross_match", """
SELECT m.billing_id, c.email, c.name, m.client_id AS member_client_id, m.subscription_id AS member_subscription_id,
       m.updated_at AS member_updated_at, m.status AS member_status
FROM b_customers c JOIN last_member m ON m.billing_id = c.customer_id""", LAST_MEMBER)
add("cross_match_summary", """
SELECT (SELECT count(*) FROM b_customers) AS billing_customers, (SELECT count(*) FROM m_subscriptions) AS membership_records,
       (SELECT count(*) FROM b_customers WHERE customer_id IN (SELECT billing_id FROM m_subscriptions)) AS matched""")
add("join_both_systems", """
SELECT m.client_id, m.billing_id, trim(coalesce(m.first_name, '') || ' ' || coalesce(m.last_name, '')) AS full_name,
       b.name AS billing_name, b.email AS billing_email, b.address_country
FROM m_customers m JOIN b_customers b ON b.customer_id = m.billing_id""")
add("join_left_chain", """
SELECT m.client_id, m.billing_id, s1.n AS billing_total, s2.n AS membership_total, s3.n AS asset_total,
       s2.d AS distinct_tiers, s4.n AS session_total, t.current_tier_product_id, t.current_tier_name,
       t.current_tier_key, t.current_tier_perks
FROM m_customers m JOIN b_customers b ON b.customer_id = m.billing_id LEFT JOIN tier t ON t.billing_id = m.billing_id
LEFT JOIN (SELECT customer_id, count(*) AS n FROM b_subscriptions GROUP BY 1) s1 ON s1.customer_id = m.billing_id
LEFT JOIN (SELECT billing_id, count(*) AS n, count(DISTINCT product_id) AS d FROM m_subscriptions GROUP BY 1) s2
  ON s2.billing_id = m.billing_id
LEFT JOIN (SELECT billing_id, count(*) AS n FROM m_assets GROUP BY 1) s3 ON s3.billing_id = m.billing_id
LEFT JOIN (SELECT client_id, count(*) AS n FROM m_sessions GROUP BY 1) s4 ON s4.client_id = m.client_id""", TIER)
add("enrich_subscriptions", """
SELECT s.subscription_id, c.customer_id, c.name, c.default_source AS payment_method
FROM b_subscriptions s LEFT JOIN b_customers c ON c.customer_id = s.customer_id""")
add("join_tiers_dim", """
SELECT s.subscription_id, s.product_id, s.updated_at, t.name AS tier_name, t.product_key AS tier_key, t.perks AS tier_perks
FROM m_subscriptions s LEFT JOIN m_tiers t ON t.product_id = s.product_id""")
add("customer_active_value", """
SELECT c.customer_id, c.email, c.name, count(s.subscription_id) AS active_subscriptions,
       cast(sum(s.amount_cents) AS bigint) / 100 AS total_monthly_value, c.currency
FROM b_customers c JOIN b_subscriptions s ON s.customer_id = c.customer_id WHERE s.status = 'active'
GROUP BY c.customer_id, c.email, c.name, c.currency ORDER BY total_monthly_value DESC, c.customer_id LIMIT 50""")
add("customer_360_literal", """
SELECT c.customer_id, c.email, c.name, c.address_country, c.created AS customer_since,
  count(DISTINCT s.subscription_id) AS total_subscriptions,
  count(DISTINCT CASE WHEN s.status = 'active' THEN s.subscription_id END) AS active_subscriptions,
  cast(sum(CASE WHEN s.status = 'active' THEN s.amount_cents ELSE 0 END) AS bigint) / 100 AS monthly_value,
  count(DISTINCT i.invoice_id) AS total_invoices, cast(sum(i.amount_paid) AS bigint) / 100 AS lifetime_revenue,
  cast(sum(i.amount_remaining) AS bigint) / 100 AS outstanding_balance
FROM b_customers c LEFT JOIN b_subscriptions s ON s.customer_id = c.customer_id
LEFT JOIN b_invoices i ON i.customer_id = c.customer_id
GROUP BY c.customer_id, c.email, c.name, c.address_country, c.created
ORDER BY lifetime_revenue DESC NULLS LAST, c.customer_id LIMIT 100""")
add("customer_360", """
SELECT c.customer_id, c.email, c.name, c.address_country, c.created AS customer_since,
  coalesce(s.n, 0) AS total_subscriptions, coalesce(s.a, 0) AS active_subscriptions, coalesce(s.v, 0) / 100 AS monthly_value,
  coalesce(i.n, 0) AS total_invoices, i.p / 100 AS lifetime_revenue, i.r / 100 AS outstanding_balance
FROM b_customers c
LEFT JOIN (SELECT customer_id, count(DISTINCT subscription_id) AS n,
             count(DISTINCT CASE WHEN status = 'active' THEN subscription_id END) AS a,
             cast(sum(CASE WHEN status = 'active' THEN amount_cents ELSE 0 END) AS bigint) AS v
           FROM b_subscriptions GROUP BY customer_id) s ON s.customer_id = c.customer_id
LEFT JOIN (SELECT customer_id, count(DISTINCT invoice_id) AS n, cast(sum(amount_paid) AS bigint) AS p,
             cast(sum(amount_remaining) AS bigint) AS r FROM b_invoices GROUP BY customer_id) i ON i.customer_id = c.customer_id
ORDER BY lifetime_revenue DESC NULLS LAST, c.customer_id LIMIT 100""")
add("join_cohort", """
SELECT i.invoice_id, i.customer_id, i.created, i.amount_paid, cast(date_trunc('month', c.created) AS date) AS cohort_month
FROM b_invoices i JOIN b_customers c ON c.customer_id = i.customer_id WHERE i.paid""")
PEOPLE = """people AS (SELECT m.client_id, m.billing_id, m.email,
  trim(coalesce(m.first_name, '') || ' ' || coalesce(m.last_name, '')) AS full_name
  FROM m_customers m JOIN b_customers b ON b.customer_id = m.billing_id)"""
add("unnest_cars", """
SELECT p.client_id, p.email, p.full_name, a.asset_id, a.make, a.model, a.year, a.license_plate, a.color, a.vin,
       a.updated_at AS asset_updated_at, a.ingested_at AS asset_ingested_at
FROM people p JOIN m_assets a ON a.billing_id = p.billing_id""", PEOPLE)
add("unnest_sessions", """
SELECT p.client_id, p.email, s.session_id, s.session_date, s.session_type, s.session_description, s.location_id,
       s.location_name, s.location_is_active, s.updated_at AS session_updated_at, s.ingested_at AS session_ingested_at
FROM people p JOIN m_sessions s ON s.client_id = p.client_id""", PEOPLE)
add("unnest_subs_with_tiers", """
SELECT p.client_id, p.email, s.subscription_id, s.status AS sub_status, s.product_id AS sub_product_id,
       s.asset_ids AS sub_asset_ids, t.name AS tier_name, t.product_key AS tier_key, t.description AS tier_description,
       t.perks AS tier_perks, t.taxable_amount AS tier_taxable_amount, s.updated_at AS sub_updated_at,
       s.ingested_at AS sub_ingested_at
FROM people p JOIN m_subscriptions s ON s.billing_id = p.billing_id LEFT JOIN m_tiers t ON t.product_id = s.product_id""", PEOPLE)
add("unnest_billing_subscriptions", """
SELECT p.client_id, s.subscription_id, s.status AS sub_status, s.plan_name, s.plan_id, s.product_id AS billing_product_id,
       s.amount_cents AS sub_amount_cents, s.currency AS sub_currency, s.subscription_interval, s.interval_count,
       s.current_period_start, s.current_period_end, s.cancel_at_period_end, s.canceled_at, s.ended_at,
       s.collection_method, s.created AS sub_created, s.updated_at AS sub_updated_at
FROM people p JOIN b_subscriptions s ON s.customer_id = p.billing_id""", PEOPLE)
add("latest_sync_per_entity", """
SELECT h.entity_type, h.last_sync_timestamp, h.records_synced, h.sync_completed_at, h.status, h.error_message
FROM sync_history h
WHERE h.sync_completed_at = (SELECT max(x.sync_completed_at) FROM sync_history x WHERE x.entity_type = h.entity_type)""")
add("anti_missing", """
SELECT subscription_id, product_id, updated_at FROM m_subscriptions s
WHERE NOT EXISTS (SELECT 1 FROM m_tiers t WHERE t.product_id = s.product_id)""")
add("scalar_subquery_counts", """
SELECT (SELECT count(*) FROM b_customers) AS customers, (SELECT count(*) FROM b_subscriptions) AS subscriptions,
       (SELECT count(*) FROM b_invoices) AS invoices,
       (SELECT count(*) FROM b_invoices) - (SELECT count(*) FROM b_subscriptions) AS difference""")

# -- aggregations
MONEY = "cast(sum(amount_cents) AS bigint)"
add("agg_count_sum_avg", f"""
SELECT status, currency, count(*) AS subscription_count, {MONEY} / 100 AS total_mrr,
       {MONEY} / (count(amount_cents) * 100) AS avg_subscription_value
FROM b_subscriptions GROUP BY status, currency""")
for _name, _by in (("mrr_by_plan", "plan_name, subscription_interval, currency"), ("mrr_by_plan_name", "plan_name"),
                   ("mrr_by_plan_interval", "plan_name, subscription_interval")):
    add(_name, f"""SELECT {_by}, count(*) AS subscription_count, {MONEY} / 100 AS total_value
FROM b_subscriptions WHERE status = 'active' GROUP BY {_by}""")
add("sync_daily", """
SELECT entity_type, cast(sync_completed_at AS date) AS sync_date, cast(sum(records_synced) AS bigint) AS total_records,
       count(*) AS sync_count, count(*) FILTER (status = 'success') AS successful_syncs,
       count(*) FILTER (status = 'failed') AS failed_syncs
FROM sync_history WHERE sync_completed_at >= timestamp '2024-01-31' - interval '30' day GROUP BY 1, 2""")
add("churn_by_month", f"""
SELECT cast(date_trunc('month', canceled_at) AS date) AS month, count(*) AS canceled_subscriptions, {MONEY} / 100 AS churned_mrr,
       cast(sum(date_sub('day', created, canceled_at)) AS bigint) / count(*) AS avg_lifetime_days
FROM b_subscriptions WHERE canceled_at IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 12""")
add("revenue_by_month", """
SELECT cast(date_trunc('month', created) AS date) AS month, currency, count(*) AS invoice_count,
       cast(sum(amount_paid) AS bigint) / 100 AS total_revenue, cast(sum(amount_due - amount_paid) AS bigint) / 100 AS outstanding
FROM b_invoices GROUP BY 1, 2 ORDER BY 1 DESC, 2 LIMIT 12""")
add("invoice_status", """
SELECT status, paid, currency, count(*) AS invoice_count, cast(sum(total) AS bigint) / 100 AS total_amount,
       cast(sum(amount_paid) AS bigint) / 100 AS paid_amount, cast(sum(amount_remaining) AS bigint) / 100 AS remaining_amount
FROM b_invoices GROUP BY status, paid, currency""")
add("failed_payments_daily", """
SELECT cast(created AS date) AS date, currency, count(*) AS failed_attempts, cast(sum(amount_due) AS bigint) / 100 AS total_attempted
FROM b_invoices WHERE attempted AND NOT paid GROUP BY 1, 2 ORDER BY 1 DESC, 2 LIMIT 30""")
add("agg_conditional", """
SELECT plan_name, cast(sum(CASE WHEN status = 'active' THEN amount_cents ELSE 0 END) AS bigint) AS active_cents,
       count(DISTINCT CASE WHEN status = 'active' THEN customer_id END) AS active_customers
FROM b_subscriptions GROUP BY plan_name""")
add("agg_count_distinct", """
SELECT status, count(DISTINCT product_id) AS products, count(DISTINCT customer_id || '/' || plan_name) AS customer_plans
FROM b_subscriptions GROUP BY status""")
add("agg_array_struct_ordered", """
SELECT customer_id, count(*) AS n, string_agg(subscription_id, ',' ORDER BY created DESC, subscription_id DESC) AS ids,
       string_agg(cast(amount_cents AS varchar), ',' ORDER BY created DESC, subscription_id DESC) AS amounts
FROM b_subscriptions GROUP BY customer_id""")
add("agg_array_distinct_non_null", """
SELECT customer_id, string_agg(product_id, ',' ORDER BY product_id) AS product_ids
FROM (SELECT DISTINCT customer_id, product_id FROM b_subscriptions WHERE product_id IS NOT NULL) d GROUP BY customer_id""")
add("agg_min_max_dates", """
SELECT client_id, count(*) AS total, min(cast(session_date AS date)) AS first_date, max(cast(session_date AS date)) AS last_date
FROM m_sessions GROUP BY client_id""")
add("dedup_first_seen", """
SELECT client_id, billing_id, updated_at, subscription_id, product_id FROM (
  SELECT *, row_number() OVER (PARTITION BY client_id, billing_id ORDER BY updated_at, subscription_id, product_id) AS rn
  FROM m_subscriptions) r WHERE rn = 1""")
add("dedup_ordered_list", """
SELECT customer_id, string_agg(product_id, ',' ORDER BY rank) AS products FROM (
  SELECT customer_id, product_id, min(n) AS rank FROM (
    SELECT customer_id, product_id, row_number() OVER (PARTITION BY customer_id ORDER BY created, subscription_id, place) AS n
    FROM products) x GROUP BY 1, 2) y GROUP BY customer_id""", PRODUCTS)
add("customer_date_range", """
SELECT total_count, cast(floor(epoch(lo)) AS bigint) AS earliest_timestamp, cast(floor(epoch(hi)) AS bigint) AS latest_timestamp,
  strftime(lo, '%Y-%m-%d %H:%M:%S') AS earliest_date, strftime(hi, '%Y-%m-%d %H:%M:%S') AS latest_date,
  strftime(lo, '%Y-%m-%d %H:%M:%S') || ' to ' || strftime(hi, '%Y-%m-%d %H:%M:%S') AS date_range,
  round((floor(epoch(hi)) - floor(epoch(lo))) / 86400, 1) AS span_days,
  round((floor(epoch(hi)) - floor(epoch(lo))) / 86400 / 365.25::double, 2) AS span_years
FROM (SELECT count(*) AS total_count, min(created) AS lo, max(created) AS hi FROM b_customers) x""")
add("sub_counts", """
SELECT coalesce(b.customer_id, s.billing_id) AS billing_id, b.n AS billing_total, b.a AS billing_active, b.c AS billing_canceled,
  s.n AS membership_total, s.a AS membership_active, s.d AS distinct_tiers, a.n AS assets
FROM (SELECT customer_id, count(*) AS n, count(*) FILTER (status = 'active') AS a, count(*) FILTER (status = 'canceled') AS c
      FROM b_subscriptions GROUP BY 1) b
FULL JOIN (SELECT billing_id, count(*) AS n, count(*) FILTER (status = 'active') AS a, count(DISTINCT product_id) AS d
      FROM m_subscriptions WHERE billing_id IS NOT NULL GROUP BY 1) s ON s.billing_id = b.customer_id
LEFT JOIN (SELECT billing_id, count(*) AS n FROM m_assets WHERE billing_id IS NOT NULL GROUP BY 1) a
  ON a.billing_id = coalesce(b.customer_id, s.billing_id)""")
ORACLE["table_row_counts"] = over_views(" UNION ALL ".join(
    f"SELECT '{label}' AS table_name, count(*) AS row_count, count(*) > 0 AS populated FROM {source}"
    for label, source in (
        ("b_customers", "b_customers"), ("b_subscriptions", "b_subscriptions"), ("b_invoices", "b_invoices"),
        ("m_customers", "m_customers"), ("m_subscriptions", "m_subscriptions"), ("m_tiers", "m_tiers"),
        ("m_sessions", "m_sessions"), ("m_assets", "m_assets"), ("sync_history", "sync_history"),
        ("raw_billing_customers", "b_customers"), ("raw_billing_subscriptions", "b_subscriptions"),
        ("raw_tiers", "m_tiers"), ("unified_customers", "(SELECT 1 FROM m_customers m JOIN b_customers b ON b.customer_id = m.billing_id) u"),
    )))
add("new_high_watermark", "SELECT count(*) AS records, max(coalesce(cast(epoch(created) AS bigint), 0)) AS watermark FROM b_customers")
add("top_customers_12mo", """
SELECT c.customer_id, c.email, c.name, c.address_country, count(DISTINCT i.invoice_id) AS invoice_count,
  cast(sum(i.amount_paid) AS bigint) / 100 AS total_revenue_12mo,
  cast(sum(i.amount_paid) AS bigint) / (count(i.amount_paid) * 100) AS avg_invoice_value, i.currency
FROM b_customers c JOIN b_invoices i ON i.customer_id = c.customer_id
WHERE i.created >= timestamp '2001-08-01' - interval '12' month AND i.paid
GROUP BY c.customer_id, c.email, c.name, c.address_country, i.currency
ORDER BY total_revenue_12mo DESC, c.customer_id, i.currency LIMIT 50""")

# -- windows
add("latest_billing_sub", """
SELECT customer_id, subscription_id, status, plan_name, amount_cents, currency, subscription_interval, current_period_end,
       cancel_at_period_end, created FROM latest_billing""", LATEST_BILLING)
add("latest_membership_sub", "SELECT billing_id, subscription_id, status, product_id, updated_at FROM latest_membership",
    LATEST_MEMBERSHIP)
add("current_tier", "SELECT * FROM tier", TIER)
add("latest_session", """
SELECT client_id, session_id, session_date, session_type, session_description, location_name FROM last_session""", LAST_SESSION)
LATEST_ASSET = """latest_asset AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY billing_id ORDER BY updated_at DESC, asset_id DESC) AS rn
  FROM m_assets WHERE billing_id IS NOT NULL) r WHERE rn = 1)"""
add("latest_car", "SELECT billing_id, asset_id, make, model, year, license_plate, updated_at FROM latest_asset", LATEST_ASSET)
RUNNING = """
SELECT cast(date_trunc('month', created) AS date) AS month, count(*) AS {0},
       cast(sum(count(*)) OVER (ORDER BY date_trunc('month', created) NULLS FIRST) AS bigint) AS {1} FROM {2}
GROUP BY date_trunc('month', created)"""
add("running_total", RUNNING.format("new_subscriptions", "cumulative_subscriptions", "b_subscriptions"))
add("customer_growth", RUNNING.format("new_customers", "cumulative_customers", "b_customers"))
SHARE = "round(count(*) * 100.0::double / sum(count(*)) OVER (), 2) AS percentage"
add("share_of_total", f"SELECT plan_name, count(*) AS subscription_count, {SHARE} FROM b_subscriptions GROUP BY plan_name")
add("customers_by_country", f"""
SELECT address_country AS country, count(*) AS customer_count, {SHARE} FROM b_customers
WHERE address_country IS NOT NULL GROUP BY address_country ORDER BY customer_count DESC, country LIMIT 20""")
add("renewal_rate", f"""
SELECT renewal_status, count(*) AS subscription_count, {SHARE} FROM (SELECT {RENEWAL} AS renewal_status FROM b_subscriptions) x
GROUP BY renewal_status""")

# -- sort and limit
add("order_multi", """
SELECT subscription_id, status, plan_name, amount_cents,
       row_number() OVER (ORDER BY status DESC, plan_name, amount_cents DESC, subscription_id) AS position FROM b_subscriptions""")
add("topk_subscriptions", """
SELECT subscription_id, customer_id, amount_cents FROM b_subscriptions ORDER BY amount_cents DESC, subscription_id LIMIT 50""")
add("limit_unordered", """
SELECT client_id, billing_id, full_name FROM people ORDER BY client_id LIMIT 20""", PEOPLE)
add("null_order", """
SELECT entity_type, sync_completed_at, sync_started_at, 'desc' AS direction,
       row_number() OVER (ORDER BY sync_completed_at DESC NULLS LAST, sync_started_at) AS position FROM sync_history
UNION ALL SELECT entity_type, sync_completed_at, sync_started_at, 'asc',
       row_number() OVER (ORDER BY sync_completed_at NULLS FIRST, sync_started_at) FROM sync_history""")

# -- set operations
add("dq_duplicates", " UNION ALL ".join(
    f"""SELECT '{label}' AS table_name, count(*) AS total_rows, count(DISTINCT {key}) AS unique_ids,
count(*) - count(DISTINCT {key}) AS duplicates FROM b_{label}"""
    for label, key in (("customers", "customer_id"), ("subscriptions", "subscription_id"), ("invoices", "invoice_id"))))
add("dq_freshness", " UNION ALL ".join(
    f"""SELECT '{label}' AS table_name, count(*) AS records, max(ingested_at) AS last_ingested,
date_sub('hour', max(ingested_at), timestamp '2024-03-01 00:00:00') AS hours_since_last_update FROM b_{label}"""
    for label in ("customers", "subscriptions", "invoices")))
add("dq_raw_vs_processed", " UNION ALL ".join(
    f"""SELECT '{label}' AS entity, count(*) AS raw_count, count(DISTINCT {key}) AS processed_count,
count(DISTINCT {key}) - count(*) AS difference FROM b_{label}"""
    for label, key in (("customers", "customer_id"), ("subscriptions", "subscription_id"), ("invoices", "invoice_id"))))
add("union_seed_rows", """
SELECT entity_type, count(*) AS rows, cast(sum(records_synced) AS bigint) AS records_synced,
       count(*) FILTER (status = 'pending') AS pending
FROM (SELECT entity_type, records_synced, status FROM sync_history
      UNION ALL SELECT 'customers', 0, 'pending' UNION ALL SELECT 'subscriptions', 0, 'pending') x GROUP BY entity_type""")
add("union_distinct_keep_first", """
SELECT customer_id AS id, 0 AS source FROM b_customers WHERE delinquent
UNION ALL SELECT billing_id, 1 FROM m_customers WHERE billing_id IS NOT NULL
  AND billing_id NOT IN (SELECT customer_id FROM b_customers WHERE delinquent)""")

# -- scalar functions
add("scalar_datetime", """
SELECT subscription_id, cast(canceled_at AS date) AS canceled_day, cast(date_trunc('month', canceled_at) AS date) AS month,
  canceled_at - interval '1' month AS month_before, canceled_at + interval '7' day AS week_after,
  date_sub('day', canceled_at, timestamp '2002-01-01 12:30:00') AS days,
  date_sub('hour', canceled_at, timestamp '2002-01-01 12:30:00') AS hours,
  date_diff('month', date_trunc('month', created), date_trunc('month', canceled_at)) AS months,
  cast(epoch(canceled_at) AS bigint) AS seconds, canceled_at AS back_again,
  coalesce(strftime(canceled_at, '%Y-%m-%d %H:%M:%S'), '') AS printed FROM b_subscriptions""")
add("scalar_string", """
SELECT customer_id, coalesce(nullif(email, ''), nullif(phone, ''), nullif(name, '')) AS reach, nullif(email, '') AS email,
  coalesce(email, 'none') AS plain, trim(coalesce(name, '') || ' ' || coalesce(phone, '')) AS joined, 'Customer' AS title,
  nullif(email, '') IS NOT NULL AS has_email FROM b_customers""")
add("scalar_json", """
SELECT subscription_id, status, subscription_interval AS plan_interval, subscription_interval = 'year' AS product_is_object,
  cast(NULL AS varchar) AS sixth_item, cast(epoch(created) AS bigint) AS created_seconds FROM b_subscriptions""")
add("scalar_array", """
SELECT c.customer_id, coalesce(d.n, 0) AS n, d.f AS first_id FROM b_customers c
LEFT JOIN (SELECT customer_id, count(DISTINCT product_id) AS n, min(product_id) AS f FROM b_subscriptions
  WHERE product_id IS NOT NULL GROUP BY customer_id) d USING (customer_id)""")
add("scalar_math", """
SELECT customer_id, balance / 100 AS balance_usd, round(balance / 1000, 1) AS rounded,
  cast(split_part(customer_id, '_', 2) AS bigint) / 2 AS half,
  balance / nullif(cast(split_part(customer_id, '_', 2) AS bigint), 0) AS safe_ratio,
  created IS NOT NULL AND delinquent AS flag,
  CASE WHEN balance < 0 THEN 'owes' WHEN balance = 0 THEN 'even' ELSE 'credit' END AS standing,
  cast(address_postal_code AS bigint) AS postal_number, try_cast(name AS bigint) AS not_a_number FROM b_customers""")

# -- incremental and streaming
add("incremental_sync_history", """
SELECT 'customers' AS entity_type, x.mark AS last_sync_timestamp, x.n AS records_synced, x.at AS sync_completed_at,
       'success' AS status FROM (
  SELECT max(coalesce(created, timestamp '1970-01-01')) AS mark, count(*) AS n, timestamp '2024-02-01 00:00:00' AS at FROM b_customers
  WHERE coalesce(created, timestamp '1970-01-01') <= timestamp '1997-01-01'
  UNION ALL SELECT max(created), count(*), timestamp '2024-02-02 00:00:00' FROM b_customers WHERE created > (
    SELECT max(created) FROM b_customers WHERE created <= timestamp '1997-01-01')
  UNION ALL SELECT max(created), 0, timestamp '2024-02-03 00:00:00' FROM b_customers) x""")
add("late_records", "SELECT customer_id, created FROM b_customers WHERE created > timestamp '1997-01-01'")
add("stream_dedup", """
SELECT customer_id, page, place FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY page, place) AS rn FROM (
    SELECT customer_id, page, cast(row_number() OVER (PARTITION BY page ORDER BY subscription_id) - 1 AS int) AS place FROM (
      SELECT *, cast(split_part(subscription_id, '_', -1) AS bigint) // 100 + 1 AS page FROM b_subscriptions) p) q) r WHERE rn = 1""")
add("stream_unreadable_pages", """
SELECT page, 'no list of records' AS reason, (SELECT count(*) FROM m_tiers
  WHERE (cast(split_part(product_id, '_', 2) AS bigint) // 100 + 1) % 3 <> 2) AS kept
FROM (SELECT DISTINCT cast(split_part(product_id, '_', 2) AS bigint) // 100 + 1 AS page FROM m_tiers) p WHERE page % 3 = 2""")
EARLY = "coalesce(created, timestamp '1970-01-01') <= timestamp '1997-01-01'"
STORED = """
SELECT 'raw' AS stored_in, customer_id AS key, 1 AS rows FROM b_customers WHERE {where}
UNION ALL SELECT 'processed', customer_id, 1 FROM b_customers WHERE {where}
UNION ALL SELECT 'audit', 'customers 2024-02-01 success', count(*) FROM b_customers WHERE """ + EARLY
SECOND = f"""
UNION ALL SELECT 'audit', 'customers 2024-02-02 success', count(*) FROM b_customers WHERE NOT ({EARLY})"""
add("rerun_after_compaction", STORED.format(where="true") + SECOND)
add("sync_new_files", STORED.format(where="true") + SECOND + """
UNION ALL SELECT 'audit', 'customers 2024-02-03 success', 0
UNION ALL SELECT 'files', 'batch 1', 1 UNION ALL SELECT 'files', 'batch 2', 1""")
add("sync_late_files", f"""
SELECT 'raw' AS stored_in, customer_id AS key, CASE WHEN {EARLY} THEN 1 ELSE 2 END AS rows FROM b_customers WHERE created IS NOT NULL
UNION ALL SELECT 'processed', customer_id, CASE WHEN {EARLY} THEN 1 ELSE 2 END FROM b_customers WHERE created IS NOT NULL
UNION ALL SELECT 'audit', 'customers 2024-02-01 success', count(*) FROM b_customers WHERE NOT ({EARLY})
UNION ALL SELECT 'audit', 'customers 2024-02-02 success', 0
UNION ALL SELECT 'audit', 'customers 2024-02-03 success', count(created) FROM b_customers
UNION ALL SELECT 'files', 'batch 1', 1 UNION ALL SELECT 'files', 'batch 2', 1 UNION ALL SELECT 'files', 'batch 3', 2""")
add("sync_metrics", f"""
SELECT s.stored_in, b.batch, b.n AS rows, b.newest FROM (VALUES ('raw'), ('processed')) s(stored_in), (
  SELECT 1 AS batch, count(*) AS n, '2024-02-01 00:00:00' AS newest FROM b_customers WHERE {EARLY}
  UNION ALL SELECT 2, count(*), '2024-02-02 00:00:00' FROM b_customers) b
UNION ALL SELECT 'unreadable', 1, 1, NULL UNION ALL SELECT 'unreadable', 2, 0, NULL""")
add("dq_freshness_observed", f"""
SELECT stored_in AS table_name, count(*) + count(*) FILTER ({EARLY}) AS records, timestamp '2024-02-02 00:00:00' AS last_ingested,
  date_sub('hour', timestamp '2024-02-02 00:00:00', timestamp '2024-03-01 00:00:00') AS hours_since_last_update
FROM b_customers, (VALUES ('raw'), ('processed')) s(stored_in) GROUP BY 1""")
add("dq_raw_vs_processed_observed", f"""
SELECT 'customers' AS entity, count(*) + count(*) FILTER ({EARLY}) AS raw_count, count(DISTINCT customer_id) AS processed_count,
  count(DISTINCT customer_id) - count(*) - count(*) FILTER ({EARLY}) AS difference FROM b_customers""")
add("killed_between_writes", f"""
SELECT *, 'before' AS moment FROM ({STORED.format(where=EARLY)}) x
UNION ALL SELECT *, 'after' FROM ({STORED.format(where="true") + SECOND}) y""")
add("read_as_of_version", """
SELECT version, status, count(*) AS rows FROM b_invoices, (VALUES (1), (2), (3), (4)) v(version)
WHERE version IN (2, 3) OR (version = 1 AND created < timestamp '1997-01-01')
   OR (version = 4 AND (created >= timestamp '1997-01-01' OR status = 'paid')) GROUP BY 1, 2""")
add("full_refresh_contents", """
SELECT 'tiers' AS table_name, product_id AS key, name AS value FROM m_tiers
UNION ALL SELECT 'customers', client_id, billing_id FROM m_customers
UNION ALL SELECT 'subscriptions', subscription_id, status FROM (
  SELECT *, row_number() OVER (PARTITION BY subscription_id ORDER BY client_id DESC, billing_id DESC NULLS LAST, status DESC NULLS LAST) AS rn
  FROM m_subscriptions) s WHERE rn = 1
UNION ALL SELECT 'sessions', session_id, client_id FROM last_session JOIN m_customers USING (client_id)
UNION ALL SELECT DISTINCT 'assets', json_extract_string(asset_ids, '$[0]'), client_id FROM m_subscriptions""", LAST_SESSION)
add("full_refresh_sync", """
SELECT 'tiers' AS table_name, count(*) AS row_count FROM m_tiers UNION ALL SELECT 'customers', count(*) FROM m_customers
UNION ALL SELECT 'subscriptions', count(DISTINCT subscription_id) FROM m_subscriptions
UNION ALL SELECT 'sessions', count(*) FROM last_session JOIN m_customers USING (client_id)
UNION ALL SELECT 'assets', count(DISTINCT json_extract_string(asset_ids, '$[0]') || '/' || client_id) FROM m_subscriptions""",
    LAST_SESSION)
add("full_sync_run", """
SELECT 'membership' AS step, 'success' AS status, (SELECT count(*) FROM m_customers) + (SELECT count(*) FROM m_subscriptions) AS rows,
       cast(NULL AS varchar) AS error
UNION ALL SELECT 'customers', 'success', count(*), NULL FROM b_customers
UNION ALL SELECT 'subscriptions', 'success', count(*), NULL FROM b_subscriptions
UNION ALL SELECT 'unified_customers', 'success', count(*), NULL FROM people
UNION ALL SELECT 'bi_snapshot', 'success', count(*), NULL FROM people
UNION ALL SELECT 'run', 'success', 0, NULL""", PEOPLE)

# -- end products
UNIFIED = TIER + """,
u_billing AS (SELECT customer_id, count(*) AS n, string_agg(subscription_id, ',' ORDER BY created DESC, subscription_id DESC) AS ids,
  count(DISTINCT product_id) AS products FROM b_subscriptions GROUP BY 1),
u_products AS (SELECT customer_id, string_agg(product_id, ',' ORDER BY product_id) AS ids FROM (
  SELECT DISTINCT customer_id, product_id FROM b_subscriptions WHERE product_id IS NOT NULL) d GROUP BY 1),
u_membership AS (SELECT billing_id, count(*) AS n, string_agg(subscription_id, ',' ORDER BY subscription_id) AS ids,
  count(*) FILTER (status = 'active') AS active, count(DISTINCT product_id) AS products FROM m_subscriptions GROUP BY 1),
u_assets AS (SELECT billing_id, count(*) AS n, string_agg(asset_id, ',' ORDER BY asset_id) AS ids FROM m_assets GROUP BY 1),
u_sessions AS (SELECT client_id, count(*) AS n, string_agg(session_id, ',' ORDER BY session_date DESC, session_id DESC) AS ids,
  min(cast(session_date AS date)) AS lo, max(cast(session_date AS date)) AS hi FROM m_sessions GROUP BY 1)"""
CHAIN = BOTH + """
LEFT JOIN u_billing ub ON ub.customer_id = m.billing_id LEFT JOIN u_products up ON up.customer_id = m.billing_id
LEFT JOIN u_membership um ON um.billing_id = m.billing_id LEFT JOIN u_assets ua ON ua.billing_id = m.billing_id
LEFT JOIN u_sessions us ON us.client_id = m.client_id"""
COUNTS = """coalesce(ub.n, 0) AS billing_subscriptions_count, coalesce(ub.products, 0) AS billing_product_ids_count,
coalesce(um.n, 0) AS membership_subscriptions_count, coalesce(ua.n, 0) AS assets_count, coalesce(us.n, 0) AS sessions_count"""
add("unified_customers", f"""
SELECT {SCALARS}, {COUNTS}, coalesce(ub.ids, '') AS billing_subscriptions_ids,
  coalesce(um.ids, '') AS membership_subscriptions_ids, coalesce(ua.ids, '') AS assets_ids,
  coalesce(us.ids, '') AS sessions_ids, coalesce(up.ids, '') AS billing_product_list {CHAIN}""", UNIFIED)
ORACLE["ctas_unified"] = ORACLE["unified_customers"]
add("unified_counts", f"""
SELECT m.client_id, m.billing_id, m.email, trim(coalesce(m.first_name, '') || ' ' || coalesce(m.last_name, '')) AS full_name,
{COUNTS} {CHAIN}""", UNIFIED)
BI_SOURCES = ", ".join([UNIFIED, LATEST_BILLING, LAST_SESSION, LATEST_ASSET])
BI = f"""
SELECT m.client_id, m.billing_id, m.email, m.first_name, m.last_name,
  trim(coalesce(m.first_name, '') || ' ' || coalesce(m.last_name, '')) AS full_name, m.phone_number,
  cast(m.customer_created_date AS date) AS membership_since, cast(b.created AS date) AS billing_customer_since,
  b.address_line1, b.address_city, b.address_state, b.address_country, b.address_postal_code,
  t.current_tier_product_id, t.current_tier_name, t.current_tier_key, t.current_tier_perks,
  coalesce(up.ids, '') AS billing_product_ids, m.updated_at AS last_synced_at,
  lb.subscription_id AS latest_billing_sub_id, lb.status AS latest_billing_sub_status, lb.plan_name AS latest_billing_plan_name,
  lb.amount_cents / 100 AS latest_billing_plan_amount, lb.currency AS latest_billing_plan_currency,
  lb.subscription_interval AS latest_billing_plan_interval, lb.current_period_end AS latest_billing_period_end,
  lb.cancel_at_period_end AS canceling_at_period_end, lb.created AS latest_billing_sub_created_at,
  coalesce(ub.n, 0) AS total_billing_subscriptions, coalesce(bc.active, 0) AS active_billing_subscriptions,
  coalesce(bc.canceled, 0) AS canceled_billing_subscriptions,
  lm.subscription_id AS latest_membership_sub_id, lm.status AS latest_membership_sub_status,
  lm.updated_at AS latest_membership_sub_updated_at, coalesce(um.n, 0) AS total_membership_subscriptions,
  coalesce(um.active, 0) AS active_membership_subscriptions, coalesce(um.products, 0) AS distinct_tiers_used,
  la.make AS latest_asset_make, la.model AS latest_asset_model, la.year AS latest_asset_year,
  la.license_plate AS latest_asset_license_plate, coalesce(ua.n, 0) AS total_assets,
  ls.session_id AS latest_session_id, cast(ls.session_date AS date) AS latest_session_date,
  ls.session_type AS latest_session_type, ls.session_description AS latest_session_description,
  ls.location_name AS latest_session_location, coalesce(us.n, 0) AS total_sessions,
  us.lo AS first_session_date, us.hi AS last_session_date, {STATUS.format('lb.status')} AS customer_status,
  timestamp '2024-02-02 00:00:00' AS snapshot_at {CHAIN}
LEFT JOIN latest_billing lb ON lb.customer_id = m.billing_id LEFT JOIN latest_membership lm ON lm.billing_id = m.billing_id
LEFT JOIN latest_asset la ON la.billing_id = m.billing_id LEFT JOIN last_session ls ON ls.client_id = m.client_id
LEFT JOIN (SELECT customer_id, count(*) FILTER (status = 'active') AS active, count(*) FILTER (status = 'canceled') AS canceled
  FROM b_subscriptions GROUP BY 1) bc ON bc.customer_id = m.billing_id"""
add("bi_customer_360_snapshot", BI, BI_SOURCES)
add("ctas_bi_partitioned", f"SELECT *, cast(date_trunc('month', membership_since) AS date) AS since_month FROM ({BI}) x", BI_SOURCES)
add("clustered_lookup", f"""
SELECT *, cast(date_trunc('month', membership_since) AS date) AS since_month FROM ({BI}) x
WHERE client_id BETWEEN 'cl_2' AND 'cl_4'""", BI_SOURCES)
add("full_sync_contents", f"""
SELECT 'unified_customers' AS table_name, client_id AS key, billing_id AS value FROM m_customers WHERE billing_id IN (SELECT customer_id FROM b_customers)
UNION ALL SELECT 'bi_snapshot', client_id, customer_status FROM ({BI}) x
UNION ALL SELECT 'contacts', customer_id, product_id FROM reachable LEFT JOIN (
  SELECT DISTINCT customer_id, product_id FROM b_subscriptions WHERE product_id IS NOT NULL) p USING (customer_id)""",
    BI_SOURCES + """, reachable AS (SELECT customer_id FROM b_customers
  WHERE coalesce(nullif(email, ''), nullif(phone, ''), nullif(name, '')) IS NOT NULL)""")
add("join_bi_chain", f"""
SELECT client_id, billing_id, customer_status, latest_billing_sub_id, latest_membership_sub_id, latest_session_id,
       latest_asset_model, total_assets, distinct_tiers_used FROM ({BI}) x""", BI_SOURCES)
add("delinquent_customers", """
SELECT customer_id, email, name, balance / 100 AS balance_usd, created FROM b_customers WHERE delinquent""")
add("recent_customers", """
SELECT customer_id, email, name, address_country, created FROM b_customers
WHERE created >= timestamp '1996-01-01' - interval '30' day""")
add("subs_ending_soon", """
SELECT subscription_id, customer_id, status, amount_cents / 100 AS amount, currency, current_period_end, cancel_at_period_end
FROM b_subscriptions WHERE current_period_end BETWEEN timestamp '2001-07-01' AND timestamp '2001-07-08'""")
add("overdue_invoices", """
SELECT invoice_id, number, customer_id, customer_email, due_date, amount_remaining / 100 AS amount_due, currency,
       date_sub('day', due_date, timestamp '2001-08-01') AS days_overdue
FROM b_invoices WHERE status <> 'paid' AND due_date < timestamp '2001-08-01' AND amount_remaining > 0""")
FAILED = """
SELECT entity_type, sync_started_at, sync_completed_at, records_synced, error_message FROM sync_history
WHERE status = 'failed' ORDER BY sync_completed_at DESC NULLS LAST, sync_started_at DESC, entity_type"""
add("failed_syncs", FAILED + " LIMIT 20")
add("failed_syncs_all", FAILED)
add("recent_sync_log", """
SELECT entity_type, last_sync_timestamp, records_synced, status, sync_completed_at FROM sync_history
ORDER BY sync_completed_at DESC NULLS LAST, sync_started_at DESC, entity_type LIMIT 10""")
add("revenue_cohorts", """
SELECT cast(cohort AS date) AS cohort_month, cast(month AS date) AS revenue_month, date_diff('month', cohort, month) AS months_since_signup,
       count(DISTINCT customer_id) AS paying_customers, cast(sum(amount_paid) AS bigint) / 100 AS revenue
FROM (SELECT date_trunc('month', c.created) AS cohort, date_trunc('month', i.created) AS month, i.customer_id, i.amount_paid
      FROM b_customers c JOIN b_invoices i ON i.customer_id = c.customer_id WHERE i.paid) x
GROUP BY cohort, month""")
