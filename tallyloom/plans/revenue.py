"""Recurring revenue, churn and renewals, over the billing subscriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.times import after, elapsed, moment, month_of
from tallyloom.functions.values import dollars, percent_of


def amount_total(column: str = "amount_cents") -> Column:
    return dollars(F.sum(column))


def amount_average(column: str = "amount_cents") -> Column:
    """Mean over the rows that have an amount: one division, after an exact integer sum."""
    return F.try_divide(F.sum(column), F.count(column) * 100)


def share_of_total(counts: DataFrame, column: str, into: str = "percentage") -> DataFrame:
    """Adds each row's share of the whole; the total is a one-row aggregate of the same shuffle."""
    total = counts.agg(F.sum(column)).scalar()
    return counts.withColumn(into, percent_of(column, total))


def status_summary(subscriptions: DataFrame) -> DataFrame:
    return (
        subscriptions.groupBy("status", "currency")
        .agg(
            F.count(F.lit(1)).alias("subscription_count"),
            amount_total().alias("total_mrr"),
            amount_average().alias("avg_subscription_value"),
        )
        .orderBy(F.desc("subscription_count"), "status", "currency")
    )


def mrr_by(subscriptions: DataFrame, *dimensions: str) -> DataFrame:
    """Active value by any set of plan dimensions."""
    return (
        subscriptions.where(F.col("status") == "active")
        .groupBy(*dimensions)
        .agg(F.count(F.lit(1)).alias("subscription_count"), amount_total().alias("total_value"))
        .orderBy(F.desc("total_value"), *dimensions)
    )


def mrr_by_month(subscriptions: DataFrame) -> DataFrame:
    return (
        subscriptions.where(F.col("status") == "active")
        .groupBy(month_of("current_period_start").alias("month"))
        .agg(amount_total().alias("mrr"), F.count(F.lit(1)).alias("subscription_count"))
    )


def churn_by_month(subscriptions: DataFrame, months: int = 12) -> DataFrame:
    lifetime = elapsed("DAY", "created", "canceled_at")
    return (
        subscriptions.where(F.col("canceled_at").isNotNull())
        .groupBy(month_of("canceled_at").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("canceled_subscriptions"),
            amount_total().alias("churned_mrr"),
            F.try_divide(F.sum(lifetime), F.count(lifetime)).alias("avg_lifetime_days"),
        )
        .orderBy(F.desc("month"))
        .limit(months)
    )


def ending_soon(subscriptions: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    return (
        subscriptions.where(F.col("current_period_end").between(moment(as_of), after(as_of, days=days)))
        .select(
            "subscription_id", "customer_id", "status", dollars("amount_cents").alias("amount"), "currency",
            "current_period_end", "cancel_at_period_end",
        )
        .orderBy("current_period_end", "subscription_id")
    )


def renewal_status(status: str = "status", flag: str = "cancel_at_period_end") -> Column:
    active = F.col(status) == "active"
    return (
        F.when(active & ~F.col(flag), "will_renew")
        .when(active & F.col(flag), "will_cancel")
        .when(F.col(status) == "canceled", "canceled")
        .otherwise("other")
    )


def renewal_rate(subscriptions: DataFrame) -> DataFrame:
    counts = subscriptions.groupBy(renewal_status().alias("renewal_status")).agg(
        F.count(F.lit(1)).alias("subscription_count")
    )
    return share_of_total(counts, "subscription_count").orderBy(F.desc("subscription_count"), "renewal_status")
