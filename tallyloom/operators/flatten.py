"""Raw JSON records to typed rows. Input frames carry the record text in `json_data`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom import schemas
from tallyloom.functions.records import parse, with_parsed
from tallyloom.functions.times import from_seconds, parsed
from tallyloom.functions.values import first_truthy, is_truthy, truthy
from tallyloom.operators.ordinals import number_rows
from tallyloom.operators.upsert import first_seen


def now() -> Column:
    return F.localtimestamp()


def _parsed(raw: DataFrame, schema: str, *keep: str) -> DataFrame:
    return parse(raw.select("json_data", *keep), schema)


def _stamps(synced_at: Column) -> list[Column]:
    return [synced_at.alias("updated_at"), synced_at.alias("ingested_at")]


def _instant(seconds: Column) -> Column:
    """Optional Unix seconds; 0 means there is no such time."""
    return from_seconds(truthy(seconds, 0))


def judged(raw: DataFrame, schema: str, key: str) -> DataFrame:
    """Raw records with `reason`, which is null for readable ones.

    A record is unreadable if it is not JSON of the expected shape or has no key. Without this
    check such a record would turn into a row of nulls.
    """
    whole = F.from_json("json_data", f"{schema}, {schemas.CORRUPT} string", {"columnNameOfCorruptRecord": schemas.CORRUPT})
    typed = F.col("_typed")
    reason = (
        F.when(typed.isNull() | typed[schemas.CORRUPT].isNotNull(), "not readable")
        .when(~F.coalesce(is_truthy(typed[key]), F.lit(False)), f"no {key}")
    )
    return with_parsed(raw, whole, "_typed").withColumn("reason", reason).drop("_typed")


def quarantine(raw: DataFrame, schema: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Splits raw records into readable ones and (json_data, reason) of the others."""
    rows = judged(raw, schema, key)
    return rows.where("reason is null").drop("reason"), rows.where("reason is not null")


def flatten_customers(raw: DataFrame, synced_at: Column | None = None) -> DataFrame:
    r = _parsed(raw, schemas.BILLING_CUSTOMER)
    second = F.coalesce("r.created", F.lit(0).cast("long"))
    address = ("line1", "line2", "city", "state", "postal_code", "country")
    return r.select(
        F.col("r.id").alias("customer_id"), F.col("r.object").alias("object_type"),
        "r.email", "r.name", "r.description", "r.phone",
        from_seconds(second).alias("created"), second.alias("created_timestamp"),
        *[F.col(f"r.address.{part}").alias(f"address_{part}") for part in address],
        "r.currency", "r.balance", "r.delinquent", "r.default_source", "r.invoice_prefix",
        *_stamps(synced_at if synced_at is not None else now()),
    )


def flatten_subscriptions(raw: DataFrame, synced_at: Column | None = None) -> DataFrame:
    """The first line item's price describes the plan. A unit amount of 0 is stored as no amount."""
    r = _parsed(raw, schemas.BILLING_SUBSCRIPTION).withColumn("price", F.get("r.items.data", F.lit(0))["price"])
    second = F.coalesce("r.created", F.lit(0).cast("long"))
    return r.select(
        F.col("r.id").alias("subscription_id"), F.col("r.object").alias("object_type"), "r.status",
        from_seconds(second).alias("created"), second.alias("created_timestamp"),
        _instant(F.col("r.current_period_start")).alias("current_period_start"),
        _instant(F.col("r.current_period_end")).alias("current_period_end"),
        "r.cancel_at_period_end",
        _instant(F.col("r.canceled_at")).alias("canceled_at"), _instant(F.col("r.ended_at")).alias("ended_at"),
        F.col("r.customer").alias("customer_id"),
        F.coalesce(truthy("price.currency"), F.col("r.currency")).alias("currency"),
        truthy("price.unit_amount", 0).alias("amount_cents"),
        F.col("price.recurring.interval").alias("subscription_interval"), "price.recurring.interval_count",
        F.coalesce(truthy("price.nickname"), F.col("price.product")).alias("plan_name"),
        F.col("price.id").alias("plan_id"), F.col("price.product").alias("product_id"), "r.collection_method",
        *_stamps(synced_at if synced_at is not None else now()),
    )


def flatten_tiers(raw: DataFrame, synced_at: Column | None = None) -> DataFrame:
    r = _parsed(raw, schemas.TIER)
    renamed = {
        "product_key": "productKey", "metadata_order": "order", "perks": "perks", "refund_required": "refundRequired",
        "external_api_integration": "external_api_integration", "validation_rules": "validation_rules",
        "validation_description": "validation_description", "taxable_amount": "taxable_amount",
    }
    return r.select(
        F.col("r.id").alias("product_id"), "r.name", "r.description",
        *[F.col("r.metadata")[field].alias(name) for name, field in renamed.items()],
        *_stamps(synced_at if synced_at is not None else now()),
    )


def product_ids(raw: DataFrame) -> DataFrame:
    """Every product of every line item: (subscription_id, customer_id, created, place, product_id).

    A product is an id or an object with an id; objects without one are left out.
    """
    item = _parsed(raw, schemas.BILLING_SUBSCRIPTION).select(
        F.col("r.id").alias("subscription_id"), F.col("r.customer").alias("customer_id"),
        F.col("r.created").alias("created"), F.posexplode("r.items.data").alias("place", "item"),
    )
    product = F.col("item.price.product")
    is_object = F.startswith(F.ltrim(product), F.lit("{"))
    of_object = truthy(F.get_json_object(product, "$.id"))
    return item.select(
        "subscription_id", "customer_id", "created", "place",
        F.when(is_object, of_object).otherwise(product).alias("product_id"),
    ).where("product_id is not null")


def classify(raw: DataFrame, id_fields: tuple[str, ...], order: list[str]) -> DataFrame:
    """Gives raw membership records an id and a type.

    The id is the first of the given fields that is there, else row_<n> with the record's place in
    the whole feed, counted from 0. Each field is looked up in the text once.
    """
    def field(name: str) -> Column:
        return F.col(f"_fields.{name}")

    names = dict.fromkeys([*id_fields, "sessionId"])
    fields = F.struct(*[F.get_json_object("json_data", f"$.{name}").alias(name) for name in names])
    place = F.concat(F.lit("row_"), (F.col("feed_row") - 1).cast("string"))
    return with_parsed(number_rows(raw, order, "feed_row"), fields, "_fields").select(
        F.coalesce(first_truthy(*[field(f) for f in id_fields]), place).alias("id"),
        F.when(is_truthy(field("sessionId")), "session").otherwise("customer").alias("record_type"),
        "json_data", "feed_row",
    )


def parse_members(raw: DataFrame, order: list[str], mixed: bool, fields: Sequence[str] | None = None) -> DataFrame:
    """Parsed records, or those of the given fields that such records have. Parsing takes time by the number of fields."""
    schema = schemas.MIXED_RECORD if mixed else schemas.LINKED_MEMBER
    if fields is not None:
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in StructType.fromDDL(schema).fields if f.name in fields)
    return _parsed(raw, schema, *order).drop("json_data")


IDENTITY = ("clientId", "billingID", "email")
# The fields of a record that each part reads.
PART_FIELDS = {
    "customers": (*IDENTITY, "firstName", "lastName", "phoneNumber", "customerCreatedDate"),
    "subscriptions": (*IDENTITY, "subscriptions"),
    "sessions": (*IDENTITY, "sessionId", "sessionDate", "sessionType", "sessionDescription", "location",
                 "latestSession", "latestSessionLocation"),
    "assets": (*IDENTITY, "cars"),
}


class MemberFeed:
    """Splits membership records into customers, subscriptions, sessions and assets.

    `mixed` is the feed in which a session is a record of its own (and may be a customer as well);
    otherwise records are linked customers that carry their latest session. `order` names the
    columns that say in which order records arrived.
    """

    def __init__(self, raw: DataFrame, order: list[str], mixed: bool, synced_at: Column | None = None):
        self.mixed = mixed
        self.order = order
        self.stamps = _stamps(synced_at if synced_at is not None else now())
        self.raw = raw

    def _everything(self, part: str) -> DataFrame:
        # Records that were parsed and stored before come with their struct; of others only what the part reads is parsed.
        parsed_before = "r" in self.raw.columns
        records = self.raw if parsed_before else parse_members(self.raw, self.order, self.mixed, PART_FIELDS[part])
        return records.withColumn("client", F.coalesce("r.clientId", F.lit(""))).withColumn("billing", F.col("r.billingID"))

    def _members(self, part: str) -> DataFrame:
        known = F.coalesce(truthy("r.clientId"), truthy("r.billingID"), truthy("r.email")).isNotNull()
        return self._everything(part).where(known)

    def customers(self) -> DataFrame:
        """One row per (client, billing): the first record that names them."""
        rows = self._members("customers").select(
            F.col("client").alias("client_id"), F.col("billing").alias("billing_id"), "r.email",
            F.col("r.firstName").alias("first_name"), F.col("r.lastName").alias("last_name"),
            F.col("r.phoneNumber").alias("phone_number"),
            parsed("r.customerCreatedDate").alias("customer_created_date"),
            F.coalesce("billing", F.lit("")).alias("_billing_key"), *self.order,
        )
        kept = first_seen(rows, ["client_id", "_billing_key"], self.order)
        return kept.drop("_billing_key", *self.order).select("*", *self.stamps)

    def subscriptions(self) -> DataFrame:
        return self._members("subscriptions").select("client", "billing", F.explode("r.subscriptions").alias("s")).select(
            F.col("s.id").alias("subscription_id"), F.col("client").alias("client_id"),
            F.col("billing").alias("billing_id"), "s.status", F.col("s.productId").alias("product_id"),
            F.coalesce("s.carIds", F.array().cast("array<string>")).alias("asset_ids"), *self.stamps,
        )

    def sessions(self) -> DataFrame:
        if self.mixed:
            rows, session, place = self._everything("sessions"), F.col("r"), F.col("r.location")
        else:
            rows, session, place = self._members("sessions"), F.col("r.latestSession"), F.col("r.latestSessionLocation")
        return rows.where(is_truthy(session["sessionId"])).select(
            session["sessionId"].alias("session_id"), F.col("client").alias("client_id"),
            parsed(session["sessionDate"]).alias("session_date"), session["sessionType"].alias("session_type"),
            session["sessionDescription"].alias("session_description"), place["id"].alias("location_id"),
            place["name"].alias("location_name"), place["isActive"].alias("location_is_active"), *self.stamps,
        )

    def assets(self) -> DataFrame:
        """Elements of `cars` that are objects with an id (or _id)."""
        element = self._members("assets").select("client", "billing", F.explode("r.cars").alias("json_data"))
        objects = parse(element.where(F.startswith(F.ltrim("json_data"), F.lit("{"))), schemas.ASSET, "a")
        year = F.col("a.year").try_cast("bigint")
        if self.mixed:
            make, plate = F.col("a.make"), F.coalesce(truthy("a.licensePlate"), F.col("a.license_plate"))
        else:
            make = F.coalesce(truthy("a.brand"), F.col("a.make"))
            plate = F.coalesce(truthy("a.plate"), truthy("a.licensePlate"), F.col("a.license_plate"))
            year = F.coalesce(year, F.lit(0).cast("long"))
        return objects.select(
            first_truthy("a.id", "a._id").alias("asset_id"), F.col("client").alias("client_id"),
            F.col("billing").alias("billing_id"), "json_data", make.alias("make"), "a.model", year.alias("year"),
            plate.alias("license_plate"), "a.color", "a.vin", *self.stamps,
        ).where("asset_id is not null")
