"""N-gram Jaccard join: documents whose sets of five-word shingles overlap by 80 % or more, by token-combination prefixes.

1. Every shingle's document frequency is counted over the whole table (`key_exchange`). A document can only have a link if
   80 % of its shingles occur in another document; all others are alone.
2. Documents with equal sets become one class. A class's shingles are ordered from rare to frequent; two similar sets share one of
   the first |x| - ceil(0.8 |x|) + 1, and where they first meet, what can still follow in both must be enough.
3. A rare shingle of this prefix (in `RARE` classes at most) is indexed on its own: classes that meet there are candidates.
4. A frequent shingle leads its classes to a base, the class among them whose shingles are the most frequent. Each class is
   written as its difference from the base: the shingles that only one of the two has. The difference of two differences is
   the difference of the sets. Thousands of near copies share nearly everything, but their differences share little, and that
   little tells who belongs together. Classes similar to their base are linked to it, and need no comparison with one another.
5. Sets with a difference of D at most share two of the first D + 2 elements of their differences, ordered from rare to frequent
   (one, if they need share one only). That extended prefix is indexed: its rare elements one by one, pairs of its frequent
   ones. Again what can still follow must be enough.
6. Candidates are verified on the whole sets. Components of the links give each document its smallest doc_id.

Words are told apart by 64-bit hashes, shingles by a 64-bit mix of five of them, and equal sets by a 128-bit hash.

Null and empty texts and texts without words have an empty set, link with nothing, and are their own component. Fewer than five
words are one shingle. Repeated rows (also of one doc_id) are documents of their own that share a class. A null doc_id can
have links but never names a component; a component of null ids has a null id. Columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import session
from tallyloom.llm import common, key_exchange
from tallyloom.llm.components import components

WORDS = 5
PERCENT = 80
# Shingles in the prefixes of up to so many classes are indexed on their own.
RARE = 32
# Elements in the differences of up to so many classes of a base are indexed one by one, others in pairs.
RARE_ELEMENT = 512
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(31)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit numbers."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(each))
    n = len(each) - width + 1
    mixed = np.full(n, width, np.uint64)
    for k in range(width):
        mixed = (mixed ^ each[k : k + n]) * _MIX
        mixed ^= mixed >> _SHIFT
    return np.unique(mixed)


def _block_sets(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of the block's documents one after another, and where each document's begin."""
    sets = [shingles(x) for chunk in table["text"].chunks for x in common.raw_bytes(chunk)]
    starts = np.cumsum([0, *map(len, sets)])
    return np.concatenate([np.zeros(0, np.uint64), *sets]), starts


def _keys(table: pa.Table):
    flat, starts = _block_sets(table)
    keys, place, counts = np.unique(flat, return_inverse=True, return_counts=True)
    return [(keys, counts)], (flat, starts, place)


def _least(size):
    """ceil(PERCENT * size / 100), the overlap that a similar set must have."""
    return -(-PERCENT * size // 100)


_SET_SCHEMA = "doc_id long, n_shingles long, node binary, whole binary, prefix binary, alone long, central double"


def _sets(table: pa.Table, totals: list[np.ndarray], state) -> pa.Table:
    """Per document its class and, if it can have a link, its shingles and those that are shared of its prefix."""
    names = ["doc_id", "n_shingles", "node", "whole", "prefix", "alone", "central"]
    columns: list[list] = [[] for _ in names]
    if table.num_rows:
        _, (flat, starts, place) = state
        often = totals[0][place]
        for k, doc in enumerate(table["doc_id"].to_pylist()):
            mine, df = flat[starts[k] : starts[k + 1]], often[starts[k] : starts[k + 1]]
            n = len(mine)
            row = [doc, n, *[None] * 5]
            known = int((df > 1).sum())
            if n and known >= _least(n):
                first = np.lexsort((mine, df))[: n - _least(n) + 1]
                whole = mine.tobytes()
                prefix = mine[first[df[first] > 1]].tobytes()
                row[2:] = [xxhash.xxh3_128_digest(whole), whole, prefix, n - known, float(np.log(df).mean())]
            for column, value in zip(columns, row, strict=True):
                column.append(value)
    types = [pa.int64(), pa.int64(), *[pa.binary()] * 3, pa.int64(), pa.float64()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _prefixes(classes: DataFrame) -> DataFrame:
    """token, node, n, at, central for each shared shingle of the prefixes; `at` is its place in the class's order."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        prefix = [np.frombuffer(x, "<i8") for x in batch["prefix"].to_pylist()]
        sizes = [len(x) for x in prefix]
        rows = pa.array(np.repeat(np.arange(len(prefix)), sizes))
        # Shingles of one document alone come first.
        at = [a + np.arange(s) for a, s in zip(batch["alone"].to_pylist(), sizes, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(prefix)), batch["node"].take(rows), batch["n_shingles"].take(rows),
                pa.array(np.concatenate(at).astype(np.int64)), batch["central"].take(rows),
            ],
            ["token", "node", "n", "at", "central"],
        )

    rows = classes.select("node", "n_shingles", "prefix", "alone", "central")
    return common.map_arrow(rows, step, "token long, node binary, n long, at long, central double")


def _buckets(prefixes: DataFrame) -> DataFrame:
    """token, members, root: the classes of each shingle that two have at least, and the most central of them."""
    found = prefixes.groupBy("token").agg(F.count("*").alias("members"), F.max(F.struct("central", "node")).alias("root"))
    return found.where("members > 1").select("token", "members", "root.node").withColumnRenamed("node", "root")


def _alike(x: str, y: str):
    """Two sets of n elements, as their sizes allow."""
    return F.least(f"{x}.n", f"{y}.n") * 100 >= F.greatest(f"{x}.n", f"{y}.n") * PERCENT


def _met(prefixes: DataFrame, buckets: DataFrame) -> DataFrame:
    """Pairs of classes that share a rare shingle of their prefixes and can still be similar there."""
    rare = prefixes.join(buckets.where(f"members <= {RARE}").select("token"), "token").select("token", "node", "n", "at")
    x, y = rare.alias("x"), rare.alias("y")
    # Shared shingles, times 100 + PERCENT, that two similar sets have.
    wanted = (F.col("x.n") + F.col("y.n")) * PERCENT
    follow = lambda s: (F.col(f"{s}.n") - F.col(f"{s}.at")) * (100 + PERCENT) >= wanted
    same = (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node"))
    met = x.join(y, same & _alike("x", "y") & follow("x") & follow("y"))
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _differences(classes: DataFrame, prefixes: DataFrame, buckets: DataFrame) -> DataFrame:
    """root, node, n, m, reach, near, away: each class's difference, of m elements, from each of its bases.

    near: similar to the base. reach: the largest difference that a similar set can have.
    """
    frequent = buckets.where(f"members > {RARE}").select("token", "root")
    led = prefixes.select("token", "node").join(frequent, "token").select("root", "node").distinct()
    base = classes.select(F.col("node").alias("root"), F.col("n_shingles").alias("n_base"), F.col("whole").alias("base"))
    members = classes.join(led, "node").join(base, "root")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        away, near, reach = [], [], []
        for x, y, n, n_base in zip(*(batch[c].to_pylist() for c in ("whole", "base", "n_shingles", "n_base")), strict=True):
            both = np.concatenate([np.frombuffer(x, "<i8"), np.frombuffer(y, "<i8")])
            both.sort()
            new = np.append(True, both[1:] != both[:-1])
            away.append(both[new & np.append(new[1:], True)])
            near.append((100 + PERCENT) * len(away[-1]) <= (100 - PERCENT) * (n + n_base))
            reach.append((100 - PERCENT) * n // PERCENT)
        sizes = np.array([len(x) for x in away])
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(np.concatenate(away)))
        return pa.RecordBatch.from_arrays(
            [batch["root"], batch["node"], batch["n_shingles"], pa.array(sizes), pa.array(reach, pa.int64()), pa.array(near), lists],
            ["root", "node", "n", "m", "reach", "near", "away"],
        )

    schema = "root binary, node binary, n long, m long, reach long, near boolean, away array<long>"
    return common.map_arrow(members.select("root", "node", "n_shingles", "n_base", "whole", "base"), step, schema)


def _index(apart: DataFrame) -> DataFrame:
    """root, one, two, at, slack and the class's numbers, for each element or pair of elements of the extended prefixes."""
    each = apart.select("root", "node", F.explode("away").alias("token"))
    often = each.groupBy("root", "token").agg(F.count("*").alias("often")).where("often > 1")
    order = each.join(often, ["root", "token"]).groupBy("root", "node").agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("order"))
    rows = apart.drop("away").join(order, ["root", "node"])
    # Elements of one class alone come first in its order.
    alone = F.col("m") - F.size("order")
    placed = F.transform("order", lambda x, k: F.struct(x["often"].alias("often"), x["token"].alias("token"), (k + alone).alias("at")))
    rows = rows.withColumn("first", F.filter(placed, lambda x: x["at"] < F.col("reach") + 2)).drop("order")
    own = ["root", "node", "n", "m", "near"]
    # A class this close to its base may have to share one element only.
    single = rows.select(*own, "reach", F.explode("first").alias("x")).where(f"x.often <= {RARE_ELEMENT} or m <= reach + 2")
    single = single.select(*own, F.col("x.token").alias("one"), F.lit(None).cast("long").alias("two"), "x.at", F.lit(1).alias("slack"))
    frequent = rows.select(*own, F.filter("first", lambda x: x["often"] > RARE_ELEMENT).alias("first")).where("size(first) > 1")
    pair = frequent.select(*own, "first", F.posexplode("first").alias("k", "x"))
    pair = pair.select(*own, "x", F.explode(F.slice("first", F.col("k") + 2, F.size("first"))).alias("y"))
    pair = pair.select(*own, F.col("x.token").alias("one"), F.col("y.token").alias("two"), "x.at", F.lit(0).alias("slack"))
    return single.union(pair)


def _candidates(index: DataFrame) -> DataFrame:
    """Pairs of classes, not both near their base, that can still be similar where they meet."""
    x, y = index.where("not near").alias("x"), index.alias("y")
    same = (F.col("x.root") == F.col("y.root")) & (F.col("x.one") == F.col("y.one")) & F.col("x.two").eqNullSafe(F.col("y.two"))
    other = (F.col("y.near") | (F.col("x.node") < F.col("y.node"))) & (F.col("x.node") != F.col("y.node"))
    # Twice the elements that the differences must share, times 100 + PERCENT.
    twice = (F.col("x.m") + F.col("y.m")) * (100 + PERCENT) - (F.col("x.n") + F.col("y.n")) * (100 - PERCENT)
    follow = lambda s: (F.col(f"{s}.m") - F.col(f"{s}.at") + F.col("x.slack")) * 2 * (100 + PERCENT) >= twice
    met = x.join(y, same & other & _alike("x", "y") & follow("x") & follow("y"))
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets overlap enough."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("whole").alias(f"whole_{x}"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        linked = []
        for x, y, n, m in zip(*(batch[c].to_pylist() for c in ("whole_a", "whole_b", "n_a", "n_b")), strict=True):
            both = np.concatenate([np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            linked.append(100 * shared >= PERCENT * (n + m - shared))
        return batch.filter(pa.array(linked)).select(["a", "b"])

    return common.map_arrow(pairs.join(side("b"), "b").join(side("a"), "a"), step, "a binary, b binary")


def _stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def join(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (doc_id, n_shingles, node; a null node has no link) and the verified links (a, b) between nodes."""
    spark = docs.sparkSession
    folder = session.scratch(spark, "jaccard")
    rows = common.texts_of(docs)
    total = common.text_bytes(rows)
    dealt = key_exchange.with_blocks(rows, total, "doc_id", "text")
    sets = _stored(key_exchange.exchange(dealt, total, _keys, _sets, _SET_SCHEMA, drop_bits=16), folder, "sets")
    found = sets.where("node is not null")
    classes = found.groupBy("node").agg(*(F.first(x).alias(x) for x in ("n_shingles", "whole", "prefix", "alone", "central")))
    classes = _stored(classes, folder, "classes")
    prefixes = _stored(_prefixes(classes), folder, "prefixes")
    buckets = _stored(_buckets(prefixes), folder, "buckets")
    apart = _stored(_differences(classes, prefixes, buckets), folder, "apart")
    near = apart.where("near and node != root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    met = _met(prefixes, buckets).union(_candidates(_stored(_index(apart), folder, "index"))).distinct()
    far = _stored(_verified(met, classes), folder, "far")
    return sets.select("doc_id", "n_shingles", "node"), near.union(far)


def _parted(members: DataFrame, links: DataFrame) -> DataFrame:
    """The members that can have a link, with the node that names their component as `part`."""
    parts = components(links).withColumnRenamed("root", "part")
    return members.where("node is not null").join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))


def _named(members: DataFrame, links: DataFrame) -> DataFrame:
    """members with component_id."""
    linked = _parted(members, links)
    named = linked.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    linked = linked.join(named, "part").select("doc_id", "n_shingles", "component_id")
    alone = members.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone)


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs."""
    return _named(*join(docs))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that are the first of their component; of equal rows one.

    A row is known by its id and its text, so rows of one id with other texts are judged apart, and rows with a null id like all
    others. First is the least id, null last; of one id's similar texts the one of least hash. Rows without words all stay. Ids with
    texts are told apart by 64-bit hashes.
    """
    doc_id, text = docs["doc_id"].cast("long"), F.coalesce(docs["text"].cast("string"), F.lit(""))
    row = F.xxhash64(doc_id.isNull(), doc_id, text)
    rows = docs.select(doc_id.alias("id"), row.alias("row"))
    members, links = join(docs.select(row.alias("doc_id"), text.alias("text")))
    linked = _parted(members, links).select(F.col("doc_id").alias("row"), "part").distinct()
    owned = linked.join(rows.groupBy("row", "id").agg(F.count(F.lit(1)).alias("times")), "row")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    first = owned.groupBy("part").agg(F.min(rank).alias("first"))
    judged = session.checkpointed(owned.join(first, "part").select("row", "id", "times", (F.col("first.row") == F.col("row")).alias("stays")))

    def of(some: DataFrame, how: str, left: DataFrame) -> DataFrame:
        other = some.select(F.col("row").alias("row_key"), F.col("id").alias("row_id"))
        return left.join(other, (row == other["row_key"]) & doc_id.eqNullSafe(other["row_id"]), how)

    kept = of(judged.where("not stays"), "left_anti", docs)
    again = judged.where("stays and times > 1")
    if again.isEmpty():
        return kept
    # Equal rows of a component: their columns may differ, and one of them is taken.
    return of(again, "left_anti", kept).union(of(again, "left_semi", kept).dropDuplicates(["doc_id", "text"]))
