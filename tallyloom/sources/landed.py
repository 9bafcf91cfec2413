"""JSON records in the form the two systems send them, made from the test tables.

Every record is small: children travel in records of their own, so no record grows with the number
of rows a customer has. Pages hold 100 consecutive keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.times import to_seconds

PAGE_KEYS = 100


def _record(**fields: Column) -> Column:
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))


def customer_records(customers: DataFrame) -> DataFrame:
    c = F.col
    parts = ("line1", "line2", "city", "state", "postal_code", "country")
    address = F.struct(*[c(f"address_{p}").alias(p) for p in parts])
    return customers.select(
        "customer_id",
        _record(
            id=c("customer_id"), object=c("object_type"), email=c("email"), name=c("name"),
            description=c("description"), phone=c("phone"), created=to_seconds("created"), address=address,
            currency=c("currency"), balance=c("balance"), delinquent=c("delinquent"),
            default_source=c("default_source"), invoice_prefix=c("invoice_prefix"),
        ).alias("json_data"),
    )


def subscription_records(subscriptions: DataFrame, expanded: bool = False) -> DataFrame:
    """One price per subscription. Yearly plans have no nickname.

    With `expanded`, yearly plans carry their product as an object, and each has an add-on item.
    """
    c = F.col
    yearly = c("subscription_interval") == "year"

    def price(product: Column) -> Column:
        return F.struct(
            c("plan_id").alias("id"), c("amount_cents").alias("unit_amount"),
            F.when(~yearly, c("currency")).alias("currency"),
            F.when(yearly, "").otherwise(c("plan_name")).alias("nickname"), product.alias("product"),
            F.struct(c("subscription_interval").alias("interval"), "interval_count").alias("recurring"),
        )

    def item(product: Column) -> Column:
        return F.struct(price(product).alias("price"))

    def record(items: Column) -> Column:
        return _record(
            id=c("subscription_id"), object=c("object_type"), status=c("status"), created=to_seconds("created"),
            current_period_start=to_seconds("current_period_start"), current_period_end=to_seconds("current_period_end"),
            cancel_at_period_end=c("cancel_at_period_end"), canceled_at=to_seconds("canceled_at"),
            ended_at=to_seconds("ended_at"), customer=c("customer_id"), currency=c("currency"),
            collection_method=c("collection_method"), items=F.struct(items.alias("data")),
        )

    plain = record(F.array(item(c("product_id"))))
    if expanded:
        as_object = F.struct(c("product_id").alias("id"))
        add_on = F.struct(F.lit("addon").alias("id"))
        plain = F.when(yearly, record(F.array(item(as_object), item(add_on)))).otherwise(plain)
    return subscriptions.select("subscription_id", plain.alias("json_data"))


def payment_method_records(customers: DataFrame) -> DataFrame:
    address = F.struct(
        F.concat(F.lit("PM "), F.col("address_state")).alias("country"), F.lit("00000").alias("postal_code")
    )
    return customers.where(F.col("default_source").isNotNull()).select(
        _record(id=F.col("default_source"), billing_details=F.struct(address.alias("address"))).alias("json_data")
    )


def tier_records(tiers: DataFrame) -> DataFrame:
    metadata = F.struct(
        F.col("product_key").alias("productKey"), F.col("metadata_order").alias("order"), "perks",
        F.col("refund_required").alias("refundRequired"), "external_api_integration", "validation_rules",
        "validation_description", "taxable_amount",
    )
    return tiers.select(
        "product_id",
        _record(id=F.col("product_id"), name=F.col("name"), description=F.col("description"), metadata=metadata)
        .alias("json_data"),
    )


def _iso(time: str) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _member_fields() -> dict[str, Column]:
    c = F.col
    return {
        "clientId": c("client_id"), "billingID": c("billing_id"), "email": c("email"), "firstName": c("first_name"),
        "lastName": c("last_name"), "phoneNumber": c("phone_number"),
        "customerCreatedDate": _iso("customer_created_date"),
    }


def _feed(rows: DataFrame, kind: int, key: Column, record: Column) -> DataFrame:
    return rows.select(F.lit(kind).alias("feed_kind"), key.alias("feed_key"), record.alias("json_data"))


def _with_cars(record: Column, car: Column) -> Column:
    """Puts a list of a car, a text and an empty object into a JSON object."""
    cars = F.concat(F.lit(',"cars":['), car, F.lit(',"no car",{}]}'))
    return F.concat(F.substring(record, F.lit(1), F.length(record) - 1), cars)


def _subscription_feed(subscriptions: DataFrame, mixed: bool) -> DataFrame:
    c = F.col
    # One expression for both places, which Spark evaluates once.
    assets = F.from_json("asset_ids", "array<string>")
    asset = F.get(assets, F.lit(0))
    child = F.struct(
        c("subscription_id").alias("id"), c("status").alias("status"), c("product_id").alias("productId"),
        assets.alias("carIds"),
    )
    record = _record(clientId=c("client_id"), billingID=c("billing_id"), subscriptions=F.array(child))
    if mixed:
        car = _record(id=asset, make=c("status"), model=c("product_id"), license_plate=c("subscription_id"))
    else:
        car = _record(id=F.lit(""), _id=asset, brand=F.lit(""), make=c("status"), model=c("product_id"),
                      plate=c("subscription_id"))
    return _feed(subscriptions, 1, c("subscription_id"), _with_cars(record, car))


def linked_feed(members: DataFrame, subscriptions: DataFrame, latest_sessions: DataFrame) -> DataFrame:
    """Linked customers: one record per member with the latest session, one per subscription."""
    s = F.col("latest")
    session = F.struct(
        s["session_id"].alias("sessionId"), _iso("latest.session_date").alias("sessionDate"),
        s["session_type"].alias("sessionType"), s["session_description"].alias("sessionDescription"),
    )
    location = F.struct(s["location_name"].alias("name"))
    with_session = members.join(latest_sessions, "client_id", "left")
    record = _record(**_member_fields(), latestSession=session, latestSessionLocation=location)
    return _feed(with_session, 0, F.col("client_id"), record).unionByName(_subscription_feed(subscriptions, False))


def mixed_feed(members: DataFrame, subscriptions: DataFrame, sessions: DataFrame) -> DataFrame:
    """The older feed: members, subscriptions and sessions as records of one stream."""
    c = F.col
    visit = _record(
        clientId=c("client_id"), sessionId=c("session_id"), sessionDate=_iso("session_date"),
        sessionType=c("session_type"), sessionDescription=c("session_description"),
        location=F.struct(c("location_id").alias("id"), c("location_name").alias("name"),
                          c("location_is_active").alias("isActive")),
    )
    return (
        _feed(members, 0, c("client_id"), _record(**_member_fields()))
        .unionByName(_subscription_feed(subscriptions, True))
        .unionByName(_feed(sessions, 2, c("session_id"), visit))
    )


def key_number(column: str) -> Column:
    """The number at the end of an id such as cus_17."""
    return F.substring_index(column, "_", -1).cast("long")


def pages(records: DataFrame, key: Column, form: str = "has_more") -> DataFrame:
    """Pages (page, body) of up to 100 consecutive keys.

    form: has_more or nextCursor envelopes, or 'any': lists, envelopes and something else in turn.
    """
    numbered = records.withColumn("page", F.floor(key / PAGE_KEYS) + 1)
    last = numbered.agg(F.max("page")).scalar()
    data = F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("json_data")), ","), F.lit("]"))
    more = F.col("page") < last
    if form == "has_more":
        tail = F.concat(F.lit(',"has_more":'), more.cast("string"), F.lit("}"))
        body = F.concat(F.lit('{"data":'), data, tail)
    elif form == "nextCursor":
        cursor = F.when(more, F.concat(F.lit('"c'), F.col("page").cast("string"), F.lit('"'))).otherwise("null")
        body = F.concat(F.lit('{"data":'), data, F.lit(',"nextCursor":'), cursor, F.lit("}"))
    else:
        body = (
            F.when(F.col("page") % 3 == 0, data)
            .when(F.col("page") % 3 == 1, F.concat(F.lit('{"data":'), data, F.lit("}")))
            .otherwise(F.concat(F.lit('{"items":'), data, F.lit("}")))
        )
    return numbered.groupBy("page").agg(body.alias("body"))
