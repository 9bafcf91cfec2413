"""What has to hold when one key has much of the data: row numbers, paged arrays, latest rows."""

import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tallyloom import session
from tallyloom.operators import contacts, nesting
from tallyloom.operators.ordinals import number_rows, number_rows_within
from tallyloom.operators.upsert import first_seen, newest_per_key, newest_where_repeated
from tallyloom.plans import customers, unified
from tallyloom.sinks.tables import Table


@pytest.fixture(scope="module")
def crowded(spark):
    """900 rows, a third of them under one key."""
    chance = random.Random(7)
    keys = ["hot"] * 300 + [f"k{chance.randrange(40)}" for _ in range(600)]
    chance.shuffle(keys)
    rows = [(k, chance.randrange(50), i) for i, k in enumerate(keys)]
    return rows, spark.createDataFrame(rows, "k string, t int, i int")


def test_numbers_are_the_places_in_the_order(crowded):
    rows, df = crowded
    expected = {r: n for n, r in enumerate(sorted(rows, key=lambda r: (r[0], r[1], r[2])), start=1)}
    got = {(r["k"], r["t"], r["i"]): r["ordinal"] for r in number_rows(df, ["k", "t", "i"]).collect()}
    assert got == expected


def test_numbers_in_descending_order_and_within_keys(crowded):
    rows, df = crowded
    expected = {}
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (-r[1], -r[2]))
        expected.update({r: n for n, r in enumerate(own, start=1)})
    numbered = number_rows_within(df, ["k"], ["t", "i"], descending=["t", "i"])
    assert {(r["k"], r["t"], r["i"]): r["ordinal"] for r in numbered.collect()} == expected


def test_rows_with_one_order_are_told_apart(spark):
    rows = [(None if i % 3 else "k", f"text {i}") for i in range(90)]
    df = spark.createDataFrame(rows, "k string, body string")
    got = sorted(tuple(r) for r in number_rows(df, ["k"]).select("ordinal", "k", "body").collect())
    assert [n for n, _, _ in got] == list(range(1, 91))
    assert [k for _, k, _ in got] == [None] * 60 + ["k"] * 30 and sorted(b for _, _, b in got) == sorted(b for _, b in rows)


def test_copies_get_numbers_of_their_own(spark, monkeypatch):
    monkeypatch.setattr("tallyloom.operators.ordinals.RUN", 7)
    rows = [("a", "x")] * 40 + [("a", "y"), ("b", None), ("b", None), ("c", "z")]
    got = number_rows(spark.createDataFrame(rows, "k string, body string"), ["k"], descending=["k"]).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in got] == list(range(1, len(rows) + 1))
    assert [r["k"] for r in got] == ["c", "b", "b"] + ["a"] * 41
    copies = [i for i, r in enumerate(got) if r["body"] == "x"]
    assert copies == list(range(copies[0], copies[0] + 40))


@pytest.mark.parametrize("few", [0, 20_000])
def test_few_rows_with_one_order_are_told_apart_by_themselves(spark, scratch, monkeypatch, few):
    monkeypatch.setattr("tallyloom.operators.ordinals.FEW", few)
    rows = [(i if i % 50 else None, f"text {i}") for i in range(200)] + [(7, "text 7"), (7, "other"), (9, "other")]
    spark.createDataFrame(rows, "k int, body string").write.parquet(scratch)
    numbered = number_rows(spark.read.parquet(scratch), ["k"])
    got = sorted((r["ordinal"], r["k"], r["body"]) for r in numbered.collect())
    assert [n for n, _, _ in got] == list(range(1, 204)) and sorted((g[1:] for g in got), key=repr) == sorted(rows, key=repr)
    assert [k for _, k, _ in got] == sorted((k for k, _ in rows), key=lambda k: -1 if k is None else k)
    if few:
        # Texts of all rows are shuffled once, on their way to their numbers; only rows that share their order are grouped.
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and plan.count("LeftSemi") > 0


def test_no_rows_have_no_numbers(spark):
    assert number_rows(spark.createDataFrame([], "k string, body string"), ["k"]).collect() == []


def test_texts_beside_the_order_are_neither_sorted_nor_checkpointed(spark, scratch):
    spark.range(500).selectExpr("id AS place", "repeat('long text', 50) AS body").write.parquet(scratch)
    numbered = number_rows(spark.read.parquet(scratch), ["place"])
    assert [tuple(r)[::2] for r in numbered.orderBy("place").collect()] == [(i, i + 1) for i in range(500)]
    plan = numbered._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert all("body" not in line for line in plan.splitlines() if "ExistingRDD" in line)


def test_a_crowded_key_is_spread_over_tasks(crowded):
    _, df = crowded
    parts = df.repartitionByRange(4, "k", "t", "i").withColumn("p", F.spark_partition_id())
    assert parts.where("k = 'hot'").select("p").distinct().count() > 1


@pytest.mark.parametrize("descending", [True, False])
def test_arrays_hold_everything_in_order(crowded, descending):
    rows, df = crowded
    blank = df.where("k = 'hot'").limit(3).withColumn("k", F.lit(""))
    child = nesting.Children("items", df.unionByName(blank), "k", ("t", "i"), ("t", "i"), descending)
    got = {r["k"]: [(x["t"], x["i"]) for x in r["items"]] for r in nesting.nested(child).collect()}
    assert "" not in got and set(got) == {k for k, _, _ in rows}
    for key, items in got.items():
        assert items == sorted(((t, i) for k, t, i in rows if k == key), reverse=descending)
    assert {r["k"]: r["items_count"] for r in nesting.item_counts(child).collect()} == {k: len(v) for k, v in got.items()}


def test_a_crowded_parent_is_sorted_by_all_tasks_that_read_it(crowded):
    rows, df = crowded
    child = nesting.Children("items", df.repartition(8, "i"), "k", ("t", "i"), ("t", "i"))
    tasks = {}
    for r in nesting.runs(child).withColumn("task", F.spark_partition_id()).collect():
        tasks.setdefault(r["task"], []).append((r["k"], r["t"], r["i"]))
    assert len(tasks) == 8 and all(part == sorted(part) for part in tasks.values())
    sizes = sorted(map(len, tasks.values()))
    assert sizes[-1] <= 3 * sizes[4] and sum(sizes) == len(rows)
    assert sum(any(k == "hot" for k, _, _ in part) for part in tasks.values()) == 8
    plan = nesting.nested(child)._jdf.queryExecution().executedPlan().toString()
    # Runs are made before the one shuffle by the parent.
    assert plan.index("hashpartitioning(k") < plan.index("partial_collect_list") < plan.index("Sort [k")


def test_counts_and_unnested_rows_agree_with_the_arrays(tables):
    t = tables
    children = unified.all_children(t.b_subscriptions, t.m_subscriptions, t.m_tiers, t.m_assets, t.m_sessions)
    people = unified.join_both_systems(t.m_customers, t.b_customers)
    whole = unified.attach(people, children).cache()
    counts = {r["client_id"]: r for r in unified.with_counts(people, children).collect()}
    for row in whole.select("client_id", *(F.size(a).alias(a) for a in unified.ARRAYS)).collect():
        assert all(row[a] == counts[row["client_id"]][f"{a}_count"] for a in unified.ARRAYS)
    for child in children:
        if child.name != "billing_product_ids":
            exploded = whole.select("client_id", F.inline(child.name)).select("client_id", *child.fields)
            single = unified.unnest(people, child, ["client_id"])
            assert sorted(map(str, exploded.collect())) == sorted(map(str, single.collect()))
    whole.unpersist()


def test_latest_and_first_rows(crowded):
    rows, df = crowded
    newest = {r["k"]: (r["t"], r["i"]) for r in newest_per_key(df, ["k"], ["t"]).collect()}
    oldest = {r["k"]: (r["t"], r["i"]) for r in first_seen(df, ["k"], ["i"]).collect()}
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        assert newest[key] == max((t, i) for _, t, i in own)
        assert oldest[key] == min(((t, i) for _, t, i in own), key=lambda x: x[1])


def test_null_sort_keys_do_not_hide_rows(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("b", 5, 1), ("b", None, 9)], "k string, t int, i int")
    assert sorted(map(tuple, newest_per_key(df, ["k"], ["t"]).collect())) == [("a", None, 2), ("b", 5, 1)]


def test_multiplied_totals_equal_the_pairwise_join(spark):
    people = spark.createDataFrame([("c1",), ("c2",), ("c3",), ("c4",)], "customer_id string").selectExpr(
        "customer_id", "'' email", "'' name", "'' address_country", "timestamp_ntz'2024-01-01' created")
    subs = spark.createDataFrame(
        [("c1", "s1", "active", 100), ("c1", "s2", "canceled", 50), ("c1", "s1", "active", 7), ("c2", "s3", "active", 9)],
        "customer_id string, subscription_id string, status string, amount_cents long")
    bills = spark.createDataFrame(
        [("c1", "i1", 10, 1), ("c1", "i2", 20, 2), ("c3", "i3", 30, 3)],
        "customer_id string, invoice_id string, amount_paid long, amount_remaining long")
    for name, df in (("people", people), ("subs", subs), ("bills", bills)):
        df.createOrReplaceTempView(name)
    expected = spark.sql("""
        SELECT p.customer_id, count(DISTINCT subscription_id) n, sum(CASE WHEN status = 'active' THEN amount_cents ELSE 0 END) / 100 v,
               sum(amount_paid) / 100 r, sum(amount_remaining) / 100 o
        FROM people p LEFT JOIN subs s ON s.customer_id = p.customer_id LEFT JOIN bills b ON b.customer_id = p.customer_id
        GROUP BY 1""")
    got = customers.customer_360(people, subs, bills, multiplied=True).select(
        "customer_id", "total_subscriptions", "monthly_value", "lifetime_revenue", "outstanding_balance")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_parts_of_a_shuffle_grow_in_number_with_the_tables(spark, folder, monkeypatch):
    monkeypatch.setattr(session, "PART_BYTES", 20_000)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    for name in registry.SMALL_TASKS:
        registry.queries()[name](spark, folder)
        assert int(spark.conf.get(session.PARTITIONS)) > int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert spark.conf.get(size) == "16m"
        registry.queries()["latest_session"](spark, folder)
        assert spark.conf.get(session.PARTITIONS, None) is None and spark.conf.get(size) != "16m"


def test_items_reach_their_customer_once(spark, tables):
    t, odd = tables, "ms_odd"
    subs, tiers = t.m_subscriptions, t.m_tiers
    known = tiers.limit(1).collect()[0]["product_id"]
    newest = F.expr("timestamp_ntz'2100-01-01'")
    # Ties, copies, no status, no product, an unknown product, and a tier that is listed twice.
    more = [(1, "active", known), (1, "active", known), (2, None, known), (3, "active", None), (4, "active", "none"), (6, "active", ""), (6, "active", known)]
    rows = spark.createDataFrame(more, "k int, status string, product_id string").select(
        F.lit(odd).alias("subscription_id"), F.concat(F.lit("cl_"), "k").alias("client_id"), F.concat(F.lit("cus_"), "k").alias("billing_id"),
        "status", "product_id", F.lit("[]").alias("asset_ids"), newest.alias("updated_at"), newest.alias("ingested_at"))
    subs = subs.unionByName(rows)
    tiers = tiers.unionByName(tiers.where(F.col("product_id") == known).withColumn("name", F.lit("again")))
    whole = unified.unified_customers(t.m_customers, t.b_customers, t.b_subscriptions, subs, tiers, t.m_assets, t.m_sessions)
    flat = unified.unified_scalars(t.m_customers, t.b_customers, subs, tiers)
    assert whole.columns == [*flat.columns, *unified.ARRAYS]
    found, wanted = (sorted(map(repr, x.select(*flat.columns).collect())) for x in (whole, flat))
    assert found == wanted and any("again" in x for x in found)
    products = {r[0]: r[1] for r in nesting.nested(unified.billing_product_children(t.b_subscriptions)).collect()}
    for r in whole.select("billing_id", "billing_product_ids").collect():
        assert r[1] == [x[0] for x in products.get(r[0], [])]
    text = whole._jdf.queryExecution().executedPlan().toString()
    # No summary of membership subscriptions and no distinct products are shuffled beside the lists.
    assert "partial_max(struct" not in text and "keys=[customer_id" not in text.replace("ObjectHashAggregate(keys=[customer_id", "")


def test_sessions_of_the_engine_shuffle_with_zstd(spark):
    assert spark.sparkContext.getConf().get("spark.io.compression.codec") == "zstd"


# -- disk


def shuffled_bytes(spark, before=()):
    """Bytes of shuffle files that are new since then, and these files. Reading the log and counting rows shuffle a few bytes."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    found = {f for folder in folders for f in Path(folder).rglob("shuffle_*.data")}
    return sum(f.stat().st_size for f in found - set(before) if f.exists()), found


def shuffles_go(spark, before):
    """Whether all but a few bytes of the new shuffle files go within a while."""
    until = time.time() + 20
    while (left := shuffled_bytes(spark, before)[0]) > 5_000 and time.time() < until:
        time.sleep(0.2)
    return left <= 5_000


def test_shuffle_files_go_with_the_write_that_made_them(spark, scratch):
    rows = spark.range(20_000).selectExpr("hash(id) AS k", "id AS v").groupBy("k").agg(F.max("v").alias("v"))
    table, set_before = Table(spark, scratch, "k int, v long", cluster=["k"]), spark.conf.get(session.TIDY)
    _, before = shuffled_bytes(spark)
    assert table.append(rows, 1) > 19_000 and spark.conf.get(session.TIDY) == set_before
    assert shuffles_go(spark, before)


def test_places_are_stored_once_and_compressed(spark, scratch):
    spark.range(20_000).selectExpr("hash(id) AS place", "id", "'text' AS body").write.parquet(scratch)
    _, before = shuffled_bytes(spark)
    numbered = number_rows(spark.read.parquet(scratch), ["place", "id"])
    stored_places = [f for f in numbered.inputFiles() if "/places-" in f]
    assert stored_places and all(f.endswith(".zstd.parquet") for f in stored_places)
    assert shuffles_go(spark, before) and numbered.count() == 20_000


@pytest.mark.parametrize("largest_broadcast", ["10m", "-1"])
def test_only_rows_whose_key_comes_again_are_compared(spark, largest_broadcast):
    rows = [("a", "x", i, f"v{i}") for i in (3, 9, 5)] + [("b", "x", 1, "one"), ("b", "y", 1, "two"), ("c", "x", 4, None), ("c", "x", 4, "tie")]
    blank = [(None, "x", 1, "p"), (None, "x", 1, "p"), ("", "x", 2, "q"), ("", "x", 3, "q"), ("d", None, 1, "r"), ("d", None, 2, "r")]
    df = spark.createDataFrame(rows + blank, "k string, l string, t int, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", largest_broadcast)
    try:
        newest = newest_where_repeated(df, ["k", "l"], ["t"])
        found = sorted(map(tuple, newest.collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert newest.columns == df.columns
    assert found == sorted([("a", "x", 9, "v9"), ("b", "x", 1, "one"), ("b", "y", 1, "two"), ("c", "x", 4, "tie"), *blank], key=repr)


def test_contacts_are_made_once_for_their_numbers(spark, scratch):
    spark.range(25).selectExpr("concat('c', id % 20) AS customer_id", "'e' AS email", "'n' AS name", "'p' AS phone",
                               "if(id < 20, 'x', 'y') AS product_id").write.parquet(scratch)
    bodies = contacts.chunk_bodies(spark.read.parquet(scratch), size=10)
    assert not [f for f in bodies.inputFiles() if scratch in f]
    assert sorted((r["chunk"], r["contacts"]) for r in bodies.collect()) == [(0, 10), (1, 10), (2, 5)]


def test_joins_of_items_are_done_before_lists_are_gathered(spark, tables):
    t = tables
    whole = unified.unified_customers(t.m_customers, t.b_customers, t.b_subscriptions, t.m_subscriptions, t.m_tiers, t.m_assets, t.m_sessions)
    wanted = sorted(map(repr, registry._unified_flat(whole).collect()))
    shown = registry.queries()["unified_customers"](spark, t.folder)
    # The rows of the two large lists are stored by then, so the files of the joins that made them can go.
    assert "lineitem.parquet" not in shown._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, shown.collect())) == wanted
