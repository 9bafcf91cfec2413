"""Physical plans: no pair products, no forced broadcasts of data, filters at the scan."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tallyloom.plans import summaries, unified
from tallyloom.sinks.tables import Table
from tallyloom.sources import lookups


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "customer_360_literal", "customer_360", "revenue_cohorts", "top_customers_12mo", "bi_customer_360_snapshot",
    "unified_customers", "cross_match", "contact_payloads", "enrich_subscriptions",
])
def test_no_cartesian_product(spark, folder, name):
    text = plan(registry.queries()[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_large_tables_are_never_broadcast(spark, tables):
    """With automatic broadcasts off, none is left: the code itself forces none."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("unified_customers", "bi_customer_360_snapshot", "join_tiers_dim", "cross_match", "customer_360"):
            assert "BroadcastHashJoin" not in plan(registry.queries()[name](spark, tables.folder)), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_summaries_scan_and_shuffle_once(tables):
    text = plan(summaries.billing_summary(tables.b_subscriptions))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "Window" not in text


def test_unused_aggregates_are_dropped(tables):
    text = plan(summaries.billing_summary(tables.b_subscriptions).select("customer_id", "total"))
    assert "max(struct" not in text and "o_totalprice" not in text.split("ReadSchema")[1]


def test_filters_and_columns_reach_the_scan(tables):
    text = plan(registry.REGISTRY["filter_bool"](tables))
    assert "PushedFilters: [IsNotNull" in text and "l_discount" not in text


def test_invoice_totals_skip_the_customer_join(tables):
    assert "Join" not in plan(registry.REGISTRY["revenue_by_month"](tables))


def test_unread_arrays_are_not_built(tables):
    whole = unified.unified_customers(
        tables.m_customers, tables.b_customers, tables.b_subscriptions, tables.m_subscriptions, tables.m_tiers,
        tables.m_assets, tables.m_sessions)
    text = plan(whole.select("client_id", "current_tier_key", "billing_product_ids"))
    assert "events.parquet" not in text and "p_size" not in text


def test_incremental_read_skips_partitions(spark, scratch):
    table = Table(spark, scratch, "id int, created timestamp_ntz", partition=("month", "trunc(cast(created as date), 'month')"))
    rows = spark.range(40).select(
        F.col("id").cast("int"), (F.expr("timestamp_ntz'2024-01-01'") + F.expr("make_interval(0,0,0,int(id*10))")).alias("created"))
    table.append(rows, 1)
    newer = lookups.incremental(table.read(), 1730000000, month="month")
    assert "PartitionFilters: [isnotnull(month" in plan(newer)
    assert newer.count() == table.read().where("created > timestamp_ntz'2024-10-27 03:33:20'").count() > 0


def test_top_k_does_not_sort_everything(tables):
    assert "TakeOrderedAndProject" in plan(registry.REGISTRY["topk_subscriptions"](tables))


def test_snapshot_sums_membership_subscriptions_up_once(spark, folder):
    text = plan(registry.queries()["bi_customer_360_snapshot"](spark, folder))
    # The summary with the tier, the tiers used, and the assets.
    assert text.count("lineitem.parquet") == 3
