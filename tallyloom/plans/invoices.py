"""Invoice reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.times import before, day_of, elapsed, moment, month_of, months_between_firsts
from tallyloom.functions.values import dollars


def revenue_by_month(invoices: DataFrame, limit: int = 12) -> DataFrame:
    return (
        invoices.groupBy(month_of("created").alias("month"), "currency")
        .agg(
            F.count(F.lit(1)).alias("invoice_count"),
            dollars(F.sum("amount_paid")).alias("total_revenue"),
            dollars(F.sum(F.col("amount_due") - F.col("amount_paid"))).alias("outstanding"),
        )
        .orderBy(F.desc("month"), "currency")
        .limit(limit)
    )


def payment_status(invoices: DataFrame) -> DataFrame:
    return (
        invoices.groupBy("status", "paid", "currency")
        .agg(
            F.count(F.lit(1)).alias("invoice_count"),
            dollars(F.sum("total")).alias("total_amount"),
            dollars(F.sum("amount_paid")).alias("paid_amount"),
            dollars(F.sum("amount_remaining")).alias("remaining_amount"),
        )
        .orderBy(F.desc("invoice_count"), "status", "paid", "currency")
    )


def overdue(invoices: DataFrame, as_of: str) -> DataFrame:
    return (
        invoices.where((F.col("status") != "paid") & (F.col("due_date") < moment(as_of)) & (F.col("amount_remaining") > 0))
        .select(
            "invoice_id", "number", "customer_id", "customer_email", "due_date",
            dollars("amount_remaining").alias("amount_due"), "currency",
            elapsed("DAY", "due_date", moment(as_of)).alias("days_overdue"),
        )
        .orderBy(F.desc("days_overdue"), "invoice_id")
    )


def failed_payments_daily(invoices: DataFrame, limit: int = 30) -> DataFrame:
    return (
        invoices.where(F.col("attempted") & ~F.col("paid"))
        .groupBy(day_of("created").alias("date"), "currency")
        .agg(F.count(F.lit(1)).alias("failed_attempts"), dollars(F.sum("amount_due")).alias("total_attempted"))
        .orderBy(F.desc("date"), "currency")
        .limit(limit)
    )


def revenue_cohorts(customers: DataFrame, invoices: DataFrame) -> DataFrame:
    """Paid revenue by signup month and payment month.

    Invoices shrink to one row per customer and month before they meet the customers, so the join
    is one row per customer on one side and a paying customer counts once per row on the other.
    """
    monthly = (
        invoices.where("paid")
        .groupBy("customer_id", month_of("created").alias("revenue_month"))
        .agg(F.sum("amount_paid").alias("paid_cents"))
    )
    cohorts = customers.select("customer_id", month_of("created").alias("cohort_month"))
    return (
        monthly.join(cohorts, "customer_id")
        .groupBy("cohort_month", "revenue_month")
        .agg(F.count(F.lit(1)).alias("paying_customers"), dollars(F.sum("paid_cents")).alias("revenue"))
        .withColumn("months_since_signup", months_between_firsts("cohort_month", "revenue_month"))
        .orderBy(F.desc("cohort_month"), "months_since_signup")
    )


def top_customers(customers: DataFrame, invoices: DataFrame, as_of: str, months: int = 12, limit: int = 50) -> DataFrame:
    spent = (
        invoices.where((F.col("created") >= before(as_of, months=months)) & F.col("paid"))
        .groupBy("customer_id", "currency")
        .agg(
            F.countDistinct("invoice_id").alias("invoice_count"),
            F.sum("amount_paid").alias("paid_cents"),
            F.count("amount_paid").alias("paid_rows"),
        )
    )
    return (
        customers.select("customer_id", "email", "name", "address_country")
        .join(spent, "customer_id")
        .select(
            "customer_id", "email", "name", "address_country", "invoice_count",
            dollars("paid_cents").alias("total_revenue_12mo"),
            F.try_divide("paid_cents", F.col("paid_rows") * 100).alias("avg_invoice_value"),
            "currency",
        )
        .orderBy(F.desc("total_revenue_12mo"), "customer_id", "currency")
        .limit(limit)
    )
