"""One nested record per customer known to both systems.

The membership system is the authority for identity and contact; billing adds payment, address and
subscription data. Children hang off the record as ordered arrays of structs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.picking import active_first
from tallyloom.functions.values import full_name, is_truthy
from tallyloom.operators.nesting import Children, item_counts, nested
from tallyloom.plans.summaries import current_tier, tier_of

MEMBER_COLUMNS = (
    "client_id", "billing_id", "email", "first_name", "last_name", "full_name", "phone_number",
    "membership_since", "membership_updated_at", "membership_ingested_at",
)
ADDRESS = ("address_line1", "address_line2", "address_city", "address_state", "address_postal_code", "address_country")
TIER_COLUMNS = ("current_tier_product_id", "current_tier_name", "current_tier_key", "current_tier_perks")
ARRAYS = ("billing_subscriptions", "billing_product_ids", "membership_subscriptions", "assets", "sessions")


def join_both_systems(members: DataFrame, customers: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Members with their billing customer, and columns of the members to keep; anyone known to one system only is left out."""
    member = members.where(is_truthy("billing_id")).select(
        "client_id", "billing_id", "email", "first_name", "last_name",
        full_name("first_name", "last_name").alias("full_name"), "phone_number",
        F.col("customer_created_date").alias("membership_since"),
        F.col("updated_at").alias("membership_updated_at"),
        F.col("ingested_at").alias("membership_ingested_at"), *keep,
    )
    customer = customers.select(
        F.col("customer_id").alias("billing_customer_id"), F.col("created").alias("billing_customer_since"),
        F.col("currency").alias("billing_currency"), F.col("email").alias("billing_email"),
        F.col("name").alias("billing_name"), F.col("description").alias("billing_description"),
        F.col("phone").alias("billing_phone"), *ADDRESS,
    )
    return member.join(customer, member["billing_id"] == customer["billing_customer_id"])


def unified_scalars(
    members: DataFrame, customers: DataFrame, membership_subscriptions: DataFrame, tiers: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """The flat part of the record: both systems plus the current tier, and columns of the membership summary to keep."""
    return join_both_systems(members, customers).join(
        current_tier(membership_subscriptions, tiers, keep), "billing_id", "left"
    )


def with_tiers(subscriptions: DataFrame, tiers: DataFrame) -> DataFrame:
    """Membership subscriptions with the details of their tier; unknown products keep nulls.

    No broadcast is forced: Spark broadcasts the tiers if their measured size allows it, and
    otherwise splits hot products at run time.
    """
    known = tiers.select(
        "product_id", F.col("name").alias("tier_name"), F.col("product_key").alias("tier_key"),
        F.col("description").alias("tier_description"), F.col("perks").alias("tier_perks"),
        F.col("taxable_amount").alias("tier_taxable_amount"),
    )
    return subscriptions.join(known, "product_id", "left")


def billing_subscription_children(subscriptions: DataFrame) -> Children:
    rows = subscriptions.select(
        "customer_id", "subscription_id", F.col("status").alias("sub_status"), "plan_name", "plan_id",
        F.col("product_id").alias("billing_product_id"), F.col("amount_cents").alias("sub_amount_cents"),
        F.col("currency").alias("sub_currency"), "subscription_interval", "interval_count",
        "current_period_start", "current_period_end", "cancel_at_period_end", "canceled_at", "ended_at",
        "collection_method", F.col("created").alias("sub_created"), F.col("updated_at").alias("sub_updated_at"),
    )
    return Children("billing_subscriptions", rows, "customer_id", tuple(rows.columns[1:]),
                    ("sub_created", "subscription_id"), descending=True)


def billing_product_children(subscriptions: DataFrame) -> Children:
    rows = subscriptions.where(F.col("product_id").isNotNull()).select("customer_id", "product_id").distinct()
    return Children("billing_product_ids", rows, "customer_id", ("product_id",), ("product_id",))


def membership_subscription_children(subscriptions: DataFrame, tiers: DataFrame) -> Children:
    rows = with_tiers(subscriptions, tiers).select(
        "billing_id", "subscription_id", F.col("status").alias("sub_status"),
        F.col("product_id").alias("sub_product_id"), F.col("asset_ids").alias("sub_asset_ids"),
        "tier_name", "tier_key", "tier_description", "tier_perks", "tier_taxable_amount",
        F.col("updated_at").alias("sub_updated_at"), F.col("ingested_at").alias("sub_ingested_at"),
    )
    return Children("membership_subscriptions", rows, "billing_id", tuple(rows.columns[1:]), ("subscription_id",))


def asset_children(assets: DataFrame) -> Children:
    rows = assets.select(
        "billing_id", "asset_id", "make", "model", "year", "license_plate", "color", "vin",
        F.col("updated_at").alias("asset_updated_at"), F.col("ingested_at").alias("asset_ingested_at"),
    )
    return Children("assets", rows, "billing_id", tuple(rows.columns[1:]), ("asset_id",))


def session_children(sessions: DataFrame) -> Children:
    rows = sessions.select(
        "client_id", "session_id", "session_date", "session_type", "session_description", "location_id",
        "location_name", "location_is_active", F.col("updated_at").alias("session_updated_at"),
        F.col("ingested_at").alias("session_ingested_at"),
    )
    return Children("sessions", rows, "client_id", tuple(rows.columns[1:]), ("session_date", "session_id"),
                    descending=True)


def _parent_key(child: Children) -> str:
    return "client_id" if child.key == "client_id" else "billing_id"


def _plain(child: Children, array: DataFrame) -> DataFrame:
    """Arrays under the parent's key; an array of single-field structs becomes an array of values."""
    renamed = array.withColumnRenamed(child.key, _parent_key(child))
    if len(child.fields) > 1:
        return renamed
    return renamed.withColumn(child.name, F.transform(child.name, lambda x: x[child.fields[0]]))


def attach(parents: DataFrame, children: Iterable[Children]) -> DataFrame:
    """Adds one array column per child table; parents without children get an empty array."""
    children, whole = list(children), parents
    # Children under the client id go first, while the rows that change key are still narrow; all
    # others share the billing id and its partitioning.
    for child in sorted(children, key=_parent_key, reverse=True):
        whole = whole.join(_plain(child, nested(child)), _parent_key(child), "left")
    filled = [F.coalesce(c.name, F.array().cast(whole.schema[c.name].dataType)).alias(c.name) for c in children]
    return whole.select(*parents.columns, *filled)


def all_children(
    billing_subscriptions: DataFrame, membership_subscriptions: DataFrame, tiers: DataFrame, assets: DataFrame,
    sessions: DataFrame,
) -> list[Children]:
    return [
        billing_subscription_children(billing_subscriptions), billing_product_children(billing_subscriptions),
        membership_subscription_children(membership_subscriptions, tiers), asset_children(assets), session_children(sessions),
    ]


def _tier_of_list(subscriptions: DataFrame, tiers: DataFrame) -> DataFrame:
    """What `current_tier` gives, from membership subscriptions that are nested already."""
    latest = F.array_max(F.transform("membership_subscriptions", lambda x: F.struct(
        active_first(x["sub_status"]), x["sub_updated_at"], x["subscription_id"], x["sub_status"],
        x["sub_product_id"].alias("product_id"))))
    return tier_of(subscriptions.select("billing_id", latest["product_id"].alias("product_id")), tiers)


def unified_customers(
    members: DataFrame, customers: DataFrame, billing_subscriptions: DataFrame,
    membership_subscriptions: DataFrame, tiers: DataFrame, assets: DataFrame, sessions: DataFrame,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The whole record. Items are shuffled to their customer once: current tier and billing products come out of the lists.

    The same list of membership subscriptions is read twice, as a record's array and for its tier; its shuffle is one. Sessions join
    the members while these stand under the client id, so that they follow them to the billing id and nothing else goes back.

    `keep` may store the rows of membership subscriptions and assets, which come out of joins of their own, and return them: the files
    of those shuffles can go before the lists are gathered. Without it, building the plan runs no job.
    """
    billing = billing_subscription_children(billing_subscriptions)
    membership, asset = membership_subscription_children(membership_subscriptions, tiers), asset_children(assets)
    if keep is not None:
        membership, asset = (replace(child, rows=keep(child.items)) for child in (membership, asset))
    with_sessions = attach(members.where(is_truthy("billing_id")), [session_children(sessions)])
    flat = join_both_systems(with_sessions, customers, ["sessions"])
    flat = flat.join(_tier_of_list(nested(membership), tiers), "billing_id", "left")
    whole = attach(flat, [billing, membership, asset])
    products = F.filter(F.transform("billing_subscriptions", lambda x: x["billing_product_id"]), lambda x: x.isNotNull())
    whole = whole.withColumn("billing_product_ids", F.sort_array(F.array_distinct(products)))
    return whole.select(*[n for n in flat.columns if n != "sessions"], *ARRAYS)


def unnest(parents: DataFrame, child: Children, keep: Iterable[str]) -> DataFrame:
    """One row per child with some of the parent's columns: what exploding the child's array would give."""
    key, keep = _parent_key(child), list(keep)
    kept = parents.select(F.col(key).alias("_parent"), *keep)
    return kept.join(child.items.withColumnRenamed(child.key, "_parent"), "_parent").select(*keep, *child.fields)


def with_counts(parents: DataFrame, children: Iterable[Children]) -> DataFrame:
    """Adds the number of items per child table. The items are counted in place; only numbers move."""
    children, whole = list(children), parents
    for child in sorted(children, key=_parent_key, reverse=True):
        counted = item_counts(child).withColumnRenamed(child.key, _parent_key(child))
        whole = whole.join(counted, _parent_key(child), "left")
    counts = [F.coalesce(f"{c.name}_count", F.lit(0).cast("long")).alias(f"{c.name}_count") for c in children]
    return whole.select(*parents.columns, *counts)
