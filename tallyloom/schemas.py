"""Shapes of the incoming JSON records and of the stored tables, as DDL text."""

from __future__ import annotations

ADDRESS = "struct<line1:string,line2:string,city:string,state:string,postal_code:string,country:string>"

BILLING_CUSTOMER = f"""id string, object string, email string, name string, description string, phone string,
created bigint, address {ADDRESS}, currency string, balance bigint, delinquent boolean, default_source string,
invoice_prefix string"""

# A product is an id or an object with an id; as text it can be read either way.
PRICE = """struct<id:string,unit_amount:bigint,currency:string,nickname:string,product:string,
recurring:struct<interval:string,interval_count:bigint>>"""

BILLING_SUBSCRIPTION = f"""id string, object string, status string, created bigint, current_period_start bigint,
current_period_end bigint, cancel_at_period_end boolean, canceled_at bigint, ended_at bigint, customer string,
currency string, collection_method string, items struct<data:array<struct<price:{PRICE}>>>"""

PAYMENT_METHOD = "id string, billing_details struct<address:struct<country:string,postal_code:string>>"

TIER = """id string, name string, description string, metadata struct<productKey:string,`order`:string,
perks:string,refundRequired:string,external_api_integration:string,validation_rules:string,
validation_description:string,taxable_amount:string>"""

_MEMBER = """clientId string, billingID string, email string, firstName string, lastName string,
phoneNumber string, customerCreatedDate string,
subscriptions array<struct<id:string,status:string,productId:string,carIds:array<string>>>, cars array<string>"""

_LOCATION = "struct<id:string,name:string,isActive:boolean>"

LINKED_MEMBER = f"""{_MEMBER},
latestSession struct<sessionId:string,sessionDate:string,sessionType:string,sessionDescription:string>,
latestSessionLocation {_LOCATION}"""

MIXED_RECORD = f"""{_MEMBER}, sessionId string, sessionDate string, sessionType string,
sessionDescription string, location {_LOCATION}"""

ASSET = """id string, _id string, brand string, make string, model string, year string, plate string,
licensePlate string, license_plate string, color string, vin string"""

CORRUPT = "_corrupt_record"

# Stored tables.
RAW = "id string, json_data string, ingested_at timestamp_ntz, created timestamp_ntz"
RAW_UNDATED = "id string, json_data string, ingested_at timestamp_ntz"
# feed_row is the place of a record in its feed, from 1; it keeps the order of arrival.
RAW_LINKED = f"{RAW_UNDATED}, feed_row bigint"
RAW_MIXED = "id string, record_type string, json_data string, ingested_at timestamp_ntz, feed_row bigint"

B_CUSTOMERS = """customer_id string, object_type string, email string, name string, description string, phone string,
created timestamp_ntz, created_timestamp bigint, address_line1 string, address_line2 string, address_city string,
address_state string, address_postal_code string, address_country string, currency string, balance bigint,
delinquent boolean, default_source string, invoice_prefix string, updated_at timestamp_ntz, ingested_at timestamp_ntz"""

B_SUBSCRIPTIONS = """subscription_id string, object_type string, status string, created timestamp_ntz,
created_timestamp bigint, current_period_start timestamp_ntz, current_period_end timestamp_ntz,
cancel_at_period_end boolean, canceled_at timestamp_ntz, ended_at timestamp_ntz, customer_id string, currency string,
amount_cents bigint, subscription_interval string, interval_count bigint, plan_name string, plan_id string,
product_id string, collection_method string, updated_at timestamp_ntz, ingested_at timestamp_ntz"""

M_TIERS = """product_id string, name string, description string, product_key string, metadata_order string,
perks string, refund_required string, external_api_integration string, validation_rules string,
validation_description string, taxable_amount string, updated_at timestamp_ntz, ingested_at timestamp_ntz"""

M_CUSTOMERS = """client_id string, billing_id string, email string, first_name string, last_name string,
phone_number string, customer_created_date timestamp_ntz, updated_at timestamp_ntz, ingested_at timestamp_ntz"""

M_SUBSCRIPTIONS = """subscription_id string, client_id string, billing_id string, status string, product_id string,
asset_ids array<string>, updated_at timestamp_ntz, ingested_at timestamp_ntz"""

M_SESSIONS = """session_id string, client_id string, session_date timestamp_ntz, session_type string,
session_description string, location_id string, location_name string, location_is_active boolean,
updated_at timestamp_ntz, ingested_at timestamp_ntz"""

M_ASSETS = """asset_id string, client_id string, billing_id string, json_data string, make string, model string,
year bigint, license_plate string, color string, vin string, updated_at timestamp_ntz, ingested_at timestamp_ntz"""

SYNC_HISTORY = """entity_type string, last_sync_timestamp timestamp_ntz, last_synced_id string, records_synced bigint,
sync_started_at timestamp_ntz, sync_completed_at timestamp_ntz, status string, error_message string"""
