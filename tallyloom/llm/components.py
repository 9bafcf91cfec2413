"""Connected components of a graph given by its links, by alternating stars.

Each round links every node's larger neighbours to its smallest one, then its smaller ones likewise, until nothing changes:
all nodes of a component then hang on its smallest. Only sums go to the driver. Every round is written to the shared folder,
so that lineage stays short and a lost executor repeats one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import session


def _stored(links: DataFrame, folder: str, k: int) -> DataFrame:
    links.write.parquet(f"{folder}/{k}")
    return links.sparkSession.read.parquet(f"{folder}/{k}")


def _sum(links: DataFrame) -> tuple:
    # A wrapping sum of hashes tells whether the set of links changed.
    found = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(found)


def _stars(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    large = both.where("b > a").join(least, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    large = large.distinct()
    # From here on a is the larger end.
    least = large.groupBy("a").agg(F.min("b").alias("low"))
    moved = large.join(least, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root for every node that has a link; `links` has columns a and b of one ordered type.

    Null ends, repeated links and links of a node to itself are left out; no links give no rows.
    """
    folder = session.scratch(links.sparkSession, "components")
    links = links.select("a", "b").where("a is not null and b is not null and a != b")
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    k, links = 0, _stored(links, folder, 0)
    before = _sum(links)
    while before[0]:
        k, links = k + 1, _stored(_stars(links), folder, k + 1)
        now = _sum(links)
        if now == before:
            break
        before = now
    roots = links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
