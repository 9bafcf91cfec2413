"""Hand-made records for the cases where loosely typed JSON goes wrong."""

import os

import pytest
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.functions import times, values
from tallyloom.operators import contacts, exports, flatten, matching
from tallyloom.sources import landed, lookups, pages


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_customer_without_address_or_creation_time(records):
    flat = flatten.flatten_customers(records({"id": "a", "address": None}, {"id": "b", "address": {"city": "X"}, "created": 60}))
    found = rows(flat, "customer_id", "created", "created_timestamp", "address_city", "address_country")
    assert [(str(r[1]), *r[2:]) for r in found] == [
        ("1970-01-01 00:00:00", 0, None, None), ("1970-01-01 00:01:00", 60, "X", None)]


def test_subscription_prices(records):
    def sub(name, **price):
        return {"id": name, "currency": "usd", "items": {"data": [{"price": price}] if price else []}}

    flat = flatten.flatten_subscriptions(records(
        sub("a"), sub("b", unit_amount=0, nickname="", product="p"), sub("c", unit_amount=250, nickname="n", currency="eur"),
        {"id": "d", "items": {"data": []}, "current_period_end": 0, "canceled_at": 86400},
    ))
    found = rows(flat, "subscription_id", "amount_cents", "currency", "plan_name", "current_period_end", "canceled_at")
    assert found[0] == ("a", None, "usd", None, None, None)
    assert found[1] == ("b", None, "usd", "p", None, None)
    assert found[2] == ("c", 250, "eur", "n", None, None)
    assert found[3][:5] == ("d", None, None, None, None) and str(found[3][5]) == "1970-01-02 00:00:00"


def test_zero_amount_is_zero_in_the_export(records):
    subs = records({"id": "s", "customer": "c", "items": {"data": [{"price": {"unit_amount": 0}}]}}, {"id": "t"})
    out = exports.subscription_rows(subs, records({"id": "c", "name": "", "description": "d"}), records({"id": "pm"}))
    assert rows(out, "subscription_id", "amount", "customer_name", "customer_id") == [
        ("s", 0.0, "d", "c"), ("t", None, "", "")]


def test_country_comes_from_the_payment_method(records):
    customers = records(
        {"id": "c1", "default_source": "pm", "address": {"postal_code": "9"}},
        {"id": "c2", "default_source": "pm", "address": {"country": "FR", "postal_code": "8"}},
        {"id": "c3", "default_source": "gone", "address": {"postal_code": "7"}})
    method = records({"id": "pm", "billing_details": {"address": {"country": "DE", "postal_code": "1"}}})
    subs = records(*[{"id": f"s{i}", "customer": f"c{i}"} for i in (1, 2, 3)])
    out = exports.subscription_rows(subs, customers, method)
    assert rows(out, "customer_id", "customer_country", "customer_postal_code") == [
        ("c1", "DE", "1"), ("c2", "FR", "8"), ("c3", "", "7")]


def test_product_is_an_id_or_an_object(records):
    def sub(name, *products):
        return {"id": name, "customer": "c", "created": 1, "items": {"data": [{"price": {"product": p}} for p in products]}}

    found = flatten.product_ids(records(sub("s1", "p1", {"id": "p2"}, {}), sub("s2", None, {"id": ""}, "p3")))
    assert rows(found, "subscription_id", "place", "product_id") == [("s1", 0, "p1"), ("s1", 1, "p2"), ("s2", 2, "p3")]


def test_cars_of_a_linked_customer(records):
    feed = flatten.MemberFeed(records({
        "clientId": "c", "cars": ["x", {}, {"_id": "a", "brand": "", "make": "T", "year": None}, 7, None,
                                  {"id": "", "_id": "b", "brand": "B", "plate": "", "licensePlate": "L", "year": 1999}]}),
        ["place"], mixed=False)
    assert rows(feed.assets(), "asset_id", "make", "year", "license_plate") == [("a", "T", 0, None), ("b", "B", 1999, "L")]


def test_cars_of_the_older_feed_keep_a_missing_year(records):
    feed = flatten.MemberFeed(records({"clientId": "c", "cars": [{"id": "a", "brand": "B", "year": None}]}), ["place"], mixed=True)
    assert rows(feed.assets(), "asset_id", "make", "year") == [("a", None, None)]


def test_a_record_can_be_a_customer_and_a_session(records):
    feed = flatten.MemberFeed(records({"clientId": "c", "sessionId": "s", "sessionDate": "not a date"}, {"sessionId": "t"}),
                              ["place"], mixed=True)
    assert rows(feed.customers(), "client_id") == [("c",)]
    assert rows(feed.sessions(), "session_id", "client_id", "session_date") == [("s", "c", None), ("t", "", None)]


def test_first_customer_record_wins_and_strangers_are_skipped(records):
    feed = flatten.MemberFeed(records(
        {"clientId": "c", "billingID": "b", "email": "first"}, {"clientId": "c", "billingID": "b", "email": "second"},
        {"clientId": "", "firstName": "nobody"}, {"email": "only"}, {"clientId": "c", "billingID": None, "email": "third"},
    ), ["place"], mixed=True)
    assert rows(feed.customers(), "client_id", "billing_id", "email") == [
        ("", None, "only"), ("c", "b", "first"), ("c", None, "third")]


def test_subscriptions_without_cars(records):
    feed = flatten.MemberFeed(records(
        {"clientId": "c", "subscriptions": [{"id": "s"}, {"id": "t", "carIds": ["1", "2"]}]}, {"clientId": "d", "subscriptions": None},
    ), ["place"], mixed=False)
    assert rows(feed.subscriptions(), "subscription_id", "asset_ids") == [("s", []), ("t", ["1", "2"])]


def test_raw_ids_fall_back_to_the_place_in_the_feed(records):
    found = flatten.classify(records({"clientId": "c"}, {"clientId": "", "sessionId": "s"}, {}), ("clientId", "sessionId"), ["place"])
    assert rows(found, "id", "record_type") == [("c", "customer"), ("row_2", "customer"), ("s", "session")]


def test_classify_looks_each_field_up_once(records):
    found = flatten.classify(records({"clientId": "c"}, {"sessionId": "s"}, {}), ("clientId", "sessionId"), ["place"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") == 2
    kinds = sorted((r.id, r.record_type) for r in found.collect())
    assert kinds == [("c", "customer"), ("row_2", "customer"), ("s", "session")]


def test_unreadable_records_are_set_aside(records):
    good, bad = flatten.quarantine(records({"id": "a"}, "{broken", {"id": ""}, "[1]"), schemas.BILLING_CUSTOMER, "id")
    assert good.count() == 1
    assert rows(bad, "reason") == [("no id",), ("not readable",), ("not readable",)]


def test_names(spark):
    people = spark.createDataFrame([(None, None, "n"), ("a", None, ""), ("a", "b", None)], "f string, l string, n string")
    named = people.select(values.full_name("f", "l").alias("full"), matching.display_name("n", "f", "l").alias("shown"))
    assert rows(named, "full", "shown") == [("", "n"), ("a b", "a b"), ("a", "a")]


def test_contacts(spark):
    people = spark.createDataFrame(
        [("c1", "e", None, None), ("c2", "", None, ""), ("c3", None, "n", None)], "customer_id string, email string, name string, phone string")
    bought = spark.createDataFrame([("c1", "a"), ("c1", "b"), ("c1", "b"), ("c2", "a")], "customer_id string, product_id string")
    found = contacts.contacts(people, bought)
    assert rows(found, "customer_id", "product_id") == [("c1", "a"), ("c1", "b"), ("c3", None)]
    assert rows(contacts.payloads(found), "payload")[0] == ('{"customer_id":"c1","email":"e","product_id":"a"}',)
    bodies = contacts.chunk_bodies(found, size=2)
    assert rows(bodies, "chunk", "contacts") == [(0, 2), (1, 1)]
    assert bodies.where("chunk = 1").first()["body"] == '{"customers":[{"customer_id":"c3","name":"n"}],"tags":[]}'


def test_contacts_are_never_broadcast(spark, tables):
    products = flatten.product_ids(landed.subscription_records(tables.b_subscriptions, expanded=True))
    plan = contacts.contacts(tables.b_customers, products)._jdf.queryExecution().executedPlan().toString()
    # The parsed products and their customers grow with the table; only fixed tables may be sent through the driver.
    assert plan.count("SortMergeJoin [customer_id") == 2 and "BroadcastHashJoin [customer_id" not in plan


def test_contact_files_are_bounded(spark, scratch):
    rows_ = spark.range(25).selectExpr("'c' || id AS customer_id").coalesce(1)
    contacts.write_files(rows_, scratch, size=10)
    assert len([n for n in os.listdir(scratch) if n.endswith(".json")]) == 3 and spark.read.json(scratch).count() == 25


def test_products_in_order_of_first_appearance(spark):
    bought = spark.createDataFrame(
        [("c", 2, "s2", 0, "a"), ("c", 1, "s1", 0, "b"), ("c", 1, "s1", 1, "a"), ("c", 3, "s3", 0, "z")],
        "customer_id string, created long, subscription_id string, place int, product_id string")
    assert rows(contacts.ordered_products(bought), "products") == [(["b", "a", "z"],)]


def test_pages_stop_where_a_reader_would(spark):
    def read(bodies, follow):
        made = spark.createDataFrame(list(enumerate(bodies, start=1)), "page long, body string")
        return [r[0] for r in rows(pages.envelopes(made, follow, stop=True), "json_data")]

    assert read(['{"data":[1],"has_more":true}', '{"data":[2],"has_more":false}', '{"data":[3]}'], "has_more") == ["1", "2"]
    assert read(['{"data":[1],"has_more":true}', '{"error":1}', '{"data":[3],"has_more":true}'], "has_more") == ["1"]
    assert read(['{"data":[1],"has_more":true}', "junk", '{"data":[3]}'], "has_more") == ["1"]
    assert read(['{"data":[1],"has_more":true}', '{"data":[]}', '{"data":[3]}'], "has_more") == ["1"]
    assert read(['{"data":[1],"nextCursor":"x"}', '{"data":[2],"nextCursor":null}', '{"data":[3]}'], "nextCursor") == ["1", "2"]
    assert read(["[1,2]", '{"data":[3]}', '{"data":[4,5]}'], "2") == ["1", "2", "3"]


def test_every_page_is_read_and_bad_ones_are_set_aside(spark):
    bodies = ['{"data":[1],"has_more":true}', "junk", '{"data":[]}', '{"data":[3],"has_more":false}', "[4]", None]
    made = spark.createDataFrame(list(enumerate(bodies, start=1)), "page long, body string")
    assert rows(pages.envelopes(made), "page", "json_data") == [(1, "1"), (4, "3"), (5, "4")]
    assert rows(pages.unreadable(made), "page", "body") == [(2, "junk"), (6, None)]


def test_list_or_envelope(spark):
    made = spark.createDataFrame([(1, "[1]"), (2, '{"data":[2]}'), (3, '{"items":[3]}'), (4, '{"data":"x"}'), (5, "")], "page long, body string")
    assert rows(pages.list_or_envelope(made), "page", "json_data") == [(1, "1"), (2, "2")]


def test_id_sections(spark):
    document = spark.createDataFrame(
        [('{"with":[{"id":"a"},{"x":1},{"id":"c"}],"without":[{"id":"d"},{"id":"e"},{"id":"f"}]}',)], "body string")
    sections = lookups.document_sections(document, "with", "without")
    assert sorted(r["id"] for r in lookups.capped_ids(sections, 4).collect()) == ["a", "d", "e", "f"]
    assert sorted(r["id"] for r in lookups.capped_ids(sections, 2).collect()) == ["a", "d"]


def test_last_sync_defaults_and_modes(spark):
    history = spark.createDataFrame(
        [("x", "2024-01-01 00:00:10", None, 5, None, "2024-01-02 00:00:00", "success", None),
         ("x", None, None, 0, None, "2024-01-03 00:00:00", "failed", "e")], "a string, b string, c string, d long, e string, f string, g string, h string")
    history = history.selectExpr(
        "a entity_type", "cast(b as timestamp_ntz) last_sync_timestamp", "c last_synced_id", "d records_synced",
        "cast(e as timestamp_ntz) sync_started_at", "cast(f as timestamp_ntz) sync_completed_at", "g status", "h error_message")
    assert tuple(lookups.last_sync(history, "x").first()) == ("x", None, None, 0, "failed")
    assert tuple(lookups.last_sync(history, "x", True).first()) == ("x", 1704067210, None, 5, "success")
    assert tuple(lookups.last_sync(history, "y").first()) == ("y", 0, None, 0, "pending")


def test_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.range(1).select(
            times.from_seconds(values.F.lit(90061)).cast("string").alias("t"), times.printed(values.F.lit(90061)).alias("p"),
            times.to_seconds(times.moment("1970-01-02 01:01:01")).alias("s")).first()
        assert tuple(row) == ("1970-01-02 01:01:01", "1970-01-02 01:01:01", 90061)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_seconds_are_rounded_down(spark):
    row = spark.range(1).select(
        times.to_seconds(times.moment("1970-01-01 00:00:01.999")), times.to_seconds(times.moment("1969-12-31 23:59:59.5")),
        times.to_seconds(times.moment("2024-01-30 18:30:58.999999"))).first()
    assert tuple(row) == (1, -1, 1706639458)


def test_export_writes_nothing_for_no_rows(spark, records, scratch):
    out = exports.subscription_rows(records({"id": "s", "status": "active"}), records({"id": "c"}), records({"id": "p"}))
    assert not exports.write_export(out.where("status = 'none'"), scratch)
    assert exports.write_export(out, scratch, titles=True)
    text = spark.read.text(scratch).collect()
    assert text[0][0].startswith("Subscription Id,Object Type,Status,")


@pytest.mark.parametrize("mixed", [True, False])
def test_a_part_parses_only_the_fields_it_reads(records, mixed):
    """What it reads is the same as from whole records, also beside fields of the wrong kind and in broken texts."""
    visit = {"sessionId": "s", "sessionDate": "2024-01-05T10:00:00", "location": {"id": "l"}, "latestSession": {"sessionId": "t"}}
    raw = records(
        {"clientId": "c", "firstName": "n", "subscriptions": [{"id": "u", "carIds": ["a"]}], "cars": [{"id": "a"}, "no car"], **visit},
        {"email": "e", "subscriptions": "none", "cars": [{"_id": "b"}]}, {"billingID": "b", "cars": 7, "subscriptions": [{"id": "v"}]},
        {"firstName": "nobody", "cars": [{"id": "x"}]}, '{"clientId": "broken", "cars": [{"id": "y"}]', "not json", "null",
    )
    whole = flatten.parse_members(raw, ["place"], mixed)
    others = {"customers": "cars", "subscriptions": "cars", "sessions": "subscriptions", "assets": "subscriptions"}
    for part, other in others.items():
        read, expected = (getattr(flatten.MemberFeed(x, ["place"], mixed, F.lit(None).cast("timestamp_ntz")), part)() for x in (raw, whole))
        assert read.schema == expected.schema and sorted(read.collect(), key=repr) == sorted(expected.collect(), key=repr)
        assert not expected.isEmpty()
        schema = flatten.parse_members(raw, ["place"], mixed, flatten.PART_FIELDS[part]).schema["r"].dataType
        assert "clientId" in schema.names and other not in schema.names
