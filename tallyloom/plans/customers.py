"""Customer reports: growth, geography, and values per customer.

Reports that combine customers with their subscriptions and invoices reduce each of these to one
row per customer first. Nothing is joined many-to-many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.times import before, month_of, printed, to_seconds
from tallyloom.functions.values import dollars
from tallyloom.plans.revenue import share_of_total

SECONDS_PER_DAY = 86_400
DAYS_PER_YEAR = 365.25


def running_count(rows: DataFrame, time: str, count: str, total: str) -> DataFrame:
    """Rows per month with a running total. The window sees one row per month, never the data."""
    monthly = rows.groupBy(month_of(time).alias("month")).agg(F.count(F.lit(1)).alias(count))
    return monthly.withColumn(total, F.sum(count).over(Window.orderBy("month"))).orderBy(F.desc("month"))


def growth(customers: DataFrame) -> DataFrame:
    return running_count(customers, "created", "new_customers", "cumulative_customers")


def by_country(customers: DataFrame, limit: int = 20) -> DataFrame:
    counts = (
        customers.where(F.col("address_country").isNotNull())
        .groupBy(F.col("address_country").alias("country"))
        .agg(F.count(F.lit(1)).alias("customer_count"))
    )
    return share_of_total(counts, "customer_count").orderBy(F.desc("customer_count"), "country").limit(limit)


def delinquent(customers: DataFrame) -> DataFrame:
    return (
        customers.where("delinquent")
        .orderBy(F.desc("balance"), "customer_id")
        .select("customer_id", "email", "name", dollars("balance").alias("balance_usd"), "created")
    )


def recent(customers: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    return (
        customers.where(F.col("created") >= before(as_of, days=days))
        .select("customer_id", "email", "name", "address_country", "created")
        .orderBy(F.desc("created"), "customer_id")
    )


def active_value(customers: DataFrame, subscriptions: DataFrame, limit: int = 50) -> DataFrame:
    active = (
        subscriptions.where(F.col("status") == "active")
        .groupBy("customer_id")
        .agg(F.count("subscription_id").alias("active_subscriptions"), F.sum("amount_cents").alias("cents"))
    )
    return (
        customers.select("customer_id", "email", "name", "currency")
        .join(active, "customer_id")
        .select(
            "customer_id", "email", "name", "active_subscriptions",
            dollars("cents").alias("total_monthly_value"), "currency",
        )
        .orderBy(F.desc("total_monthly_value"), "customer_id")
        .limit(limit)
    )


def _subscription_totals(subscriptions: DataFrame) -> DataFrame:
    active = F.col("status") == "active"
    return (
        subscriptions.groupBy("customer_id", "subscription_id")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.sum(F.when(active, F.col("amount_cents")).otherwise(0)).alias("cents"),
            F.coalesce(F.bool_or(active), F.lit(False)).alias("was_active"),
        )
        .groupBy("customer_id")
        .agg(
            F.count("subscription_id").alias("total_subscriptions"),
            F.count(F.when(F.col("was_active"), F.col("subscription_id"))).alias("active_subscriptions"),
            F.sum("cents").alias("active_cents"),
            F.sum("copies").alias("subscription_rows"),
        )
    )


def _invoice_totals(invoices: DataFrame) -> DataFrame:
    return (
        invoices.groupBy("customer_id", "invoice_id")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.sum("amount_paid").alias("paid"),
            F.sum("amount_remaining").alias("remaining"),
        )
        .groupBy("customer_id")
        .agg(
            F.count("invoice_id").alias("total_invoices"),
            F.sum("paid").alias("paid_cents"),
            F.sum("remaining").alias("remaining_cents"),
            F.sum("copies").alias("invoice_rows"),
        )
    )


def customer_360(customers: DataFrame, subscriptions: DataFrame, invoices: DataFrame, *, limit: int = 100,
                 multiplied: bool = False) -> DataFrame:
    """Subscriptions and invoices per customer, best customers first.

    With `multiplied`, sums are those of a join of both child tables at once: every subscription
    counts once per invoice of its customer and the other way round. The factor is the row count
    of the other child (1 if it has none), so the pairs themselves are never produced.
    """
    joined = (
        customers.select("customer_id", "email", "name", "address_country", F.col("created").alias("customer_since"))
        .join(_subscription_totals(subscriptions), "customer_id", "left")
        .join(_invoice_totals(invoices), "customer_id", "left")
    )
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    per_subscription = F.coalesce("invoice_rows", one) if multiplied else one
    per_invoice = F.coalesce("subscription_rows", one) if multiplied else one
    return (
        joined.select(
            "customer_id", "email", "name", "address_country", "customer_since",
            F.coalesce("total_subscriptions", zero).alias("total_subscriptions"),
            F.coalesce("active_subscriptions", zero).alias("active_subscriptions"),
            dollars(F.coalesce("active_cents", zero) * per_subscription).alias("monthly_value"),
            F.coalesce("total_invoices", zero).alias("total_invoices"),
            dollars(F.col("paid_cents") * per_invoice).alias("lifetime_revenue"),
            dollars(F.col("remaining_cents") * per_invoice).alias("outstanding_balance"),
        )
        .orderBy(F.desc_nulls_last("lifetime_revenue"), "customer_id")
        .limit(limit)
    )


def date_range(customers: DataFrame) -> DataFrame:
    """How many customers there are and which stretch of time they were created in.

    Takes the raw creation second; 0 and missing are not dates but still count as customers.
    """
    second = F.nullif(F.col("created_timestamp"), F.lit(0))
    span = F.col("latest_timestamp") - F.col("earliest_timestamp")
    days = span / SECONDS_PER_DAY
    return (
        customers.agg(
            F.count(F.lit(1)).alias("total_count"),
            F.min(second).alias("earliest_timestamp"),
            F.max(second).alias("latest_timestamp"),
        )
        .select(
            "total_count", "earliest_timestamp", "latest_timestamp",
            F.nullif(printed("earliest_timestamp"), F.lit("")).alias("earliest_date"),
            F.nullif(printed("latest_timestamp"), F.lit("")).alias("latest_date"),
            # The two texts readers of this report know.
            F.when(F.col("total_count") == 0, "No customers found")
            .when(F.col("earliest_timestamp").isNull(), "No creation dates found")
            .otherwise(F.concat(printed("earliest_timestamp"), F.lit(" to "), printed("latest_timestamp")))
            .alias("date_range"),
            F.round(days, 1).alias("span_days"),
            F.round(days / DAYS_PER_YEAR, 2).alias("span_years"),
        )
    )


def with_created_second(customers: DataFrame) -> DataFrame:
    return customers.withColumn("created_timestamp", to_seconds("created"))
