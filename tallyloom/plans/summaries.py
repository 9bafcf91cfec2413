"""One row per customer from each fact table: the latest row, counts and date ranges.

Each function is a single aggregate over a single scan. Callers select the columns they need and
Catalyst drops the aggregates behind the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.picking import active_first, latest
from tallyloom.functions.times import day_of
from tallyloom.functions.values import is_truthy

BILLING_LATEST = (
    "subscription_id", "status", "plan_name", "amount_cents", "currency", "subscription_interval",
    "current_period_end", "cancel_at_period_end", "created",
)
MEMBERSHIP_LATEST = ("subscription_id", "status", "product_id", "updated_at")
SESSION_LATEST = ("session_id", "session_date", "session_type", "session_description", "location_name")
ASSET_LATEST = ("asset_id", "make", "model", "year", "license_plate", "updated_at")


def billing_summary(subscriptions: DataFrame) -> DataFrame:
    status = F.col("status")
    by = [active_first(), "created", "subscription_id"]
    return (
        subscriptions.where(is_truthy("customer_id"))
        .groupBy("customer_id")
        .agg(
            latest(BILLING_LATEST, by).alias("latest"),
            F.count(F.lit(1)).alias("total"),
            F.count_if(status == "active").alias("active"),
            F.count_if(status == "canceled").alias("canceled"),
        )
    )


def membership_summary(subscriptions: DataFrame) -> DataFrame:
    by = [active_first(), "updated_at", "subscription_id"]
    return (
        subscriptions.where(is_truthy("billing_id"))
        .groupBy("billing_id")
        .agg(
            latest(MEMBERSHIP_LATEST, by).alias("latest"),
            F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("status") == "active").alias("active"),
        )
    )


def tiers_used(subscriptions: DataFrame) -> DataFrame:
    """Distinct products per customer, counted through one row per customer and product."""
    return (
        subscriptions.where(is_truthy("billing_id"))
        .groupBy("billing_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("billing_id").agg(F.count("product_id").alias("distinct_tiers"))
    )


def session_summary(sessions: DataFrame) -> DataFrame:
    by = ["session_date", "session_id"]
    return (
        sessions.where(is_truthy("client_id"))
        .groupBy("client_id")
        .agg(
            latest(SESSION_LATEST, by).alias("latest"),
            F.count(F.lit(1)).alias("total"),
            F.min(day_of("session_date")).alias("first_date"),
            F.max(day_of("session_date")).alias("last_date"),
        )
    )


def asset_summary(assets: DataFrame) -> DataFrame:
    by = ["updated_at", "asset_id"]
    return (
        assets.where(is_truthy("billing_id"))
        .groupBy("billing_id")
        .agg(latest(ASSET_LATEST, by).alias("latest"), F.count(F.lit(1)).alias("total"))
    )


def current_tier(subscriptions: DataFrame, tiers: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The tier of each customer's latest membership subscription; null fields if no such tier.

    The latest row is picked before the join, so the tiers meet one row per customer. Columns of the
    membership summary that are to be kept stand beside the tier.
    """
    picked = membership_summary(subscriptions).select("billing_id", F.col("latest.product_id").alias("product_id"), *keep)
    return tier_of(picked, tiers)


def tier_of(picked: DataFrame, tiers: DataFrame) -> DataFrame:
    """Rows with the tier of their product instead of it."""
    known = tiers.select(
        "product_id", F.col("product_id").alias("current_tier_product_id"),
        F.col("name").alias("current_tier_name"), F.col("product_key").alias("current_tier_key"),
        F.col("perks").alias("current_tier_perks"),
    )
    return picked.join(known, "product_id", "left").drop("product_id")
