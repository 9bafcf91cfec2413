"""Contacts for an outside receiver: one per customer and product, sent in chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.values import is_truthy, truthy
from tallyloom.operators.nesting import Children, nested
from tallyloom.operators.ordinals import number_rows
from tallyloom.session import scratch, stored
from tallyloom.sources.lookups import contactable

CHUNK = 10_000  # Fixed value: the receiver takes at most this many contacts per request.


def first_positions(products: DataFrame) -> DataFrame:
    """Distinct (customer, product) pairs with the place each pair first appears at."""
    return products.groupBy("customer_id", "product_id").agg(
        F.min(F.struct("created", "subscription_id", "place")).alias("seen")
    )


def ordered_products(products: DataFrame) -> DataFrame:
    """Each customer's distinct products in order of first appearance."""
    pairs = first_positions(products).select("customer_id", "product_id", "seen")
    child = Children("products", pairs, "customer_id", ("product_id",), ("seen", "product_id"))
    return nested(child).select("customer_id", F.transform("products", lambda x: x["product_id"]).alias("products"))


def contacts(customers: DataFrame, products: DataFrame) -> DataFrame:
    """One row per customer and distinct product, or one without a product.

    Customers nobody can reach (no e-mail, phone or name) are left out.
    """
    people = contactable(customers.where(is_truthy("customer_id"))).select(
        "customer_id", truthy("email").alias("email"), truthy("name").alias("name"), truthy("phone").alias("phone")
    )
    pairs = products.select("customer_id", "product_id").distinct()
    # The pairs drive the join: a customer with very many products can then be split. Spark takes what comes out of parsed
    # JSON for tiny, whatever its size, and would pass it through the driver as a broadcast; a merge never does.
    with_product = pairs.hint("merge").join(people, "customer_id")
    without = people.join(pairs.select("customer_id").distinct().hint("merge"), "customer_id", "left_anti")
    columns = ["customer_id", "email", "name", "phone", "product_id"]
    return with_product.select(columns).unionByName(
        without.withColumn("product_id", F.lit(None).cast("string")).select(columns)
    )


def payloads(rows: DataFrame) -> DataFrame:
    """Each contact as a JSON object without its empty fields."""
    return rows.select("customer_id", "product_id", F.to_json(F.struct(*rows.columns)).alias("payload"))


def chunks(rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """Numbers the contacts and assigns each to a request of at most `size`."""
    # Numbering reads its rows several times, and these come out of parsed records and joins.
    made = stored(rows, scratch(rows.sparkSession, "contacts"))
    numbered = number_rows(made, ["customer_id", "product_id"], "contact_no")
    return numbered.withColumn("chunk", F.floor((F.col("contact_no") - 1) / size))


def chunk_bodies(rows: DataFrame, tags: list[str] | None = None, size: int = CHUNK) -> DataFrame:
    """One request body per chunk. A chunk is bounded by `size`, so it fits one row."""
    contact = F.struct("customer_id", "email", "name", "phone", "product_id")
    words = F.array(*[F.lit(t) for t in tags or []]).cast("array<string>")
    return (
        chunks(rows, size)
        .groupBy("chunk")
        .agg(F.sort_array(F.collect_list(F.struct("contact_no", contact.alias("c")))).alias("sorted"))
        .select(
            "chunk", F.size("sorted").cast("long").alias("contacts"),
            F.to_json(F.struct(F.transform("sorted", lambda x: x["c"]).alias("customers"), words.alias("tags"))).alias("body"),
        )
    )


def write_files(rows: DataFrame, path: str, size: int = CHUNK) -> None:
    """The contacts as JSON lines in files of at most `size` each, for a receiver that picks up files."""
    rows.write.mode("overwrite").option("maxRecordsPerFile", size).json(path)
