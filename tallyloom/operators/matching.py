"""Matching the two systems, enriching rows, and point checks against the other side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.values import full_name, is_truthy, truthy
from tallyloom.operators.upsert import newest_per_key


def cross_match(customers: DataFrame, members: DataFrame, order: list[str]) -> DataFrame:
    """Billing customers with the last membership record that names them.

    Returns billing_id, every customer column, and every member column with the prefix member_.
    """
    last = newest_per_key(members.where(is_truthy("billing_id")), ["billing_id"], order)
    renamed = last.select(*[F.col(c).alias(f"member_{c}") for c in last.columns])
    named = customers.where(is_truthy("customer_id"))
    return named.join(renamed, named["customer_id"] == renamed["member_billing_id"]).withColumn(
        "billing_id", F.col("customer_id")
    )


def display_name(name: str, first: str, last: str) -> Column:
    return F.coalesce(truthy(name), full_name(first, last))


def display_email(billing_email: str, member_email: str) -> Column:
    return F.coalesce(truthy(billing_email), F.col(member_email), F.lit(""))


def cross_match_summary(customers: DataFrame, members: DataFrame) -> DataFrame:
    """Sizes of both sides and of the match, each a one-row aggregate.

    A customer matches if any member names it, so the match needs the members' ids only.
    """
    ids = members.where(is_truthy("billing_id")).select(F.col("billing_id").alias("customer_id")).distinct()
    matched = customers.select("customer_id").join(ids, "customer_id", "left_semi")
    rows = F.count(F.lit(1))
    return customers.agg(rows.alias("billing_customers")).select(
        "billing_customers",
        members.agg(rows).scalar().alias("membership_records"),
        matched.agg(rows).scalar().alias("matched"),
    )


def membership_probe(wanted: DataFrame, members: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Per wanted id: 'with_data' if it has memberships, 'empty' if it is known without any, else 'error'."""
    counted = (
        subscriptions.where(F.col("billing_id").isNotNull())
        .groupBy("billing_id").agg(F.count(F.lit(1)).alias("memberships"))
    )
    known = members.where(F.col("billing_id").isNotNull()).select("billing_id").distinct().withColumn("known", F.lit(True))
    ids = wanted.select(F.col("customer_id").alias("billing_id"))
    found = ids.join(known, "billing_id", "left").join(counted, "billing_id", "left")
    outcome = (
        F.when(F.col("known").isNull(), "error")
        .when(F.coalesce("memberships", F.lit(0)) > 0, "with_data")
        .otherwise("empty")
    )
    return found.select(
        F.col("billing_id").alias("customer_id"), outcome.alias("outcome"),
        F.coalesce("memberships", F.lit(0)).cast("long").alias("memberships"),
    )


def probe_summary(probes: DataFrame) -> DataFrame:
    return probes.agg(
        F.count(F.lit(1)).alias("total_tested"),
        F.count_if(F.col("outcome") == "with_data").alias("with_data"),
        F.count_if(F.col("outcome") == "empty").alias("without_data"),
        F.count_if(F.col("outcome") == "error").alias("errors"),
    )
