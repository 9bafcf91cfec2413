"""Flat export rows: a subscription with its customer, address and plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.functions.records import parse
from tallyloom.functions.times import printed
from tallyloom.functions.values import first_truthy, header_text, is_truthy, truthy

# The columns of the export, in order.
SUBSCRIPTION_EXPORT = (
    "subscription_id", "object_type", "status", "created", "created_timestamp", "current_period_start",
    "current_period_end", "customer_id", "customer_email", "customer_name", "customer_country",
    "customer_postal_code", "currency", "amount", "interval", "plan_name",
)
CUSTOMER_EXPORT = SUBSCRIPTION_EXPORT[1:]


def enrich(subscriptions: DataFrame, customers: DataFrame, payment_methods: DataFrame) -> DataFrame:
    """Raw subscriptions with the raw customer and the customer's payment method beside them.

    The customer joins its payment method first, one row to one row. Subscriptions without a
    customer stay.
    """
    s = parse(subscriptions, schemas.BILLING_SUBSCRIPTION, "s").select("s")
    c = parse(customers, schemas.BILLING_CUSTOMER, "c").select("c")
    p = parse(payment_methods, schemas.PAYMENT_METHOD, "p").select("p")
    paying = c.join(p, F.col("c.default_source") == F.col("p.id"), "left")
    return s.join(paying, F.col("s.customer") == F.col("c.id"), "left")


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def subscription_rows(subscriptions: DataFrame, customers: DataFrame, payment_methods: DataFrame) -> DataFrame:
    """The 16 export columns. Missing text is '', a missing amount of a priced item is 0.0.

    Without a country in the customer's address, country and postal code are both taken from the
    payment method, if there is one.
    """
    rows = enrich(subscriptions, customers, payment_methods).withColumn("price", F.get("s.items.data", F.lit(0))["price"])
    use_method = ~F.coalesce(is_truthy("c.address.country"), F.lit(False)) & F.col("p.id").isNotNull()
    method = F.col("p.billing_details.address")
    priced = F.col("price").isNotNull()
    values = {
        "subscription_id": _text(F.col("s.id")),
        "object_type": _text(F.col("s.object")),
        "status": _text(F.col("s.status")),
        "created": printed("s.created"),
        "created_timestamp": F.col("s.created"),
        "current_period_start": printed("s.current_period_start"),
        "current_period_end": printed("s.current_period_end"),
        "customer_id": _text(F.col("s.customer")),
        "customer_email": _text(F.col("c.email")),
        "customer_name": _text(first_truthy("c.name", "c.description")),
        "customer_country": _text(F.when(use_method, method["country"]).otherwise(F.col("c.address.country"))),
        "customer_postal_code": _text(
            F.when(use_method, method["postal_code"]).otherwise(F.col("c.address.postal_code"))
        ),
        "currency": _text(F.coalesce("price.currency", "s.currency")),
        "amount": F.when(priced, F.coalesce(F.col("price.unit_amount"), F.lit(0)) / 100),
        "interval": _text(F.col("price.recurring.interval")),
        "plan_name": _text(F.coalesce(truthy("price.nickname"), F.col("price.product"))),
    }
    return rows.select(*[value.alias(name) for name, value in values.items()])


def customer_rows(subscriptions: DataFrame, customers: DataFrame, payment_methods: DataFrame,
                  limit: int | None = None) -> DataFrame:
    """The same without the subscription id, for all subscriptions, or the first `limit` by id."""
    if limit is not None:
        ident, owner = (F.get_json_object("json_data", f"$.{field}") for field in ("id", "customer"))
        subscriptions = subscriptions.select("json_data", ident.alias("_id"), owner.alias("_owner")).orderBy("_id").limit(limit)
        owners = subscriptions.select("_owner").distinct()
        customers = customers.join(owners, F.get_json_object(customers["json_data"], "$.id") == owners["_owner"], "left_semi")
    return subscription_rows(subscriptions, customers, payment_methods).select(*CUSTOMER_EXPORT)


def write_export(rows: DataFrame, path: str, titles: bool = False) -> bool:
    """Writes delimited text with a header row per file; an empty result writes nothing.

    `titles` turns column names into words with capitals, as in a spreadsheet.
    """
    if rows.isEmpty():
        return False
    plain = rows.withColumn("amount", F.col("amount").cast("decimal(38,2)"))
    if titles:
        plain = plain.toDF(*[header_text(c) for c in plain.columns])
    plain.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)
    return True
