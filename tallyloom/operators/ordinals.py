"""Row numbers over data of any size.

A ranked window without a partition key runs in one task, and with a key it runs a hot key in one
task. Here the rows are range-partitioned by the sort order instead, so neighbouring ranges of one
key may sit in different tasks; each task numbers its own rows and a table with one line per task
supplies the offsets.

Only the columns of the order are sorted and stored. The rows then meet their numbers in a
hash join, so a long text beside the order is shuffled once and never sorted. The rows are read
again for that, and have to be the same ones each time. Rows that share their order with others are
told apart by themselves, so a few of them cost the others nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import scratch, stored

# monotonically_increasing_id keeps the row's place in its task in the low 33 bits.
PLACE_BITS = 33
# Copies of one row are numbered in runs of at most so many, which may go to different tasks.
RUN = 4096
# So many orders that several rows share go to every task, to find these rows without a shuffle of all; more are joined.
FEW = 20_000


def _first_numbers(df: DataFrame, order: Sequence[str], descending: Sequence[str]) -> tuple[DataFrame, int]:
    """(the order's columns, `_first`, `_rows`) of each distinct order, and how many of them have several rows."""
    by = [F.desc(x) if x in descending else F.asc(x) for x in order]
    # Stored with their places, so that a lost executor cannot renumber them; sorted columns take few bytes.
    placed = stored(
        df.groupBy(*order).agg(F.count(F.lit(1)).alias("_rows"))
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_place", F.monotonically_increasing_id()),
        scratch(df.sparkSession, "places"),
    ).withColumn("_slice", F.shiftright("_place", PLACE_BITS))
    tied = placed.where("_rows > 1").count()
    if tied:
        inside = Window.partitionBy("_slice").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
        before_it = F.coalesce(F.sum("_rows").over(inside), F.lit(0))
    else:
        before_it = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    # One line per shuffle partition, so this window and the broadcast have a fixed bound.
    sizes = placed.groupBy("_slice").agg(F.sum("_rows").alias("_size"))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    inside_slice = placed.withColumn("_inside", before_it)
    found = inside_slice.join(F.broadcast(offsets), "_slice").withColumn("_first", F.col("_before") + F.col("_inside") + 1)
    return found.select(*order, "_first", "_rows"), tied


def _renamed(numbers: DataFrame, order: Sequence[str], *keep: str) -> DataFrame:
    return numbers.select(*[F.col(x).alias(f"_by_{i}") for i, x in enumerate(order)], *keep)


def _same(rows: DataFrame, keyed: DataFrame, order: Sequence[str]) -> Column:
    return reduce(Column.__and__, [rows[x].eqNullSafe(keyed[f"_by_{i}"]) for i, x in enumerate(order)])


def _with_first(rows: DataFrame, numbers: DataFrame, order: Sequence[str]) -> DataFrame:
    keyed = _renamed(numbers, order, "_first")
    return rows.join(keyed.hint("shuffle_hash"), _same(rows, keyed, order)).select(*[rows[x] for x in rows.columns], "_first")


def number_rows(df: DataFrame, order: Sequence[str], into: str = "ordinal", descending: Sequence[str] = ()) -> DataFrame:
    """Number all rows from 1 in the given order; nulls come first, in descending columns last.

    Rows that are equal by the order come in that of a 64-bit hash of their other columns. Rows that
    are equal in this too count as copies of each other and are numbered in a row.
    """
    numbers, tied = _first_numbers(df, order, descending)
    if not tied:
        return _with_first(df, numbers, order).withColumnRenamed("_first", into)
    alone = _with_first(df, numbers.where("_rows = 1"), order).withColumnRenamed("_first", into)
    return alone.unionByName(_number_tied(df, numbers.where("_rows > 1"), tied, order, into, descending))


def _number_tied(df: DataFrame, shared: DataFrame, tied: int, order: Sequence[str], into: str, descending: Sequence[str]) -> DataFrame:
    """The rows whose order others have too, numbered from the first number of their order on."""
    orders = _renamed(shared, order)
    few = F.broadcast(orders) if tied <= FEW else orders
    rows = df.join(few, _same(df, orders, order), "left_semi")
    others = [x for x in df.columns if x not in order]
    told_apart = rows.withColumn("_tie", F.xxhash64(*others) if others else F.lit(0).cast("long"))
    finer = [*order, "_tie"]
    numbers, copied = _first_numbers(told_apart, finer, descending)
    # From places among these rows to places among all.
    starts = numbers.groupBy(*order).agg(F.min("_first").alias("_start"))
    keyed = _renamed(shared, order, F.col("_first").alias("_overall"))
    shifts = starts.join(keyed, _same(starts, keyed, order)).select(
        *[starts[x] for x in order], (F.col("_overall") - F.col("_start")).alias("_shift"))
    keyed = _renamed(shifts, order, "_shift")
    numbers = numbers.join(keyed, _same(numbers, keyed, order)).select(*finer, (F.col("_first") + F.col("_shift")).alias("_first"))
    if not copied:
        return _with_first(told_apart, numbers, finer).drop("_tie").withColumnRenamed("_first", into)
    # Copies are counted in the tasks that read them, so a row that is there very often is no load.
    distinct = told_apart.groupBy(*told_apart.columns).agg(F.count(F.lit(1)).alias("_copies"))
    runs = _with_first(distinct, numbers, finer).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(RUN).cast("long"))).alias("_run")
    ).hint("rebalance")
    last = F.least(F.col("_run") + RUN, "_copies") - 1
    return runs.select(*df.columns, F.explode(F.sequence("_run", last)).alias("_copy"), "_first").select(
        *df.columns, (F.col("_first") + F.col("_copy")).alias(into)
    )


def number_rows_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], into: str = "ordinal", descending: Sequence[str] = ()
) -> DataFrame:
    """Number the rows of every key from 1, without bringing a key into one task."""
    numbered = number_rows(df, [*keys, *order], "_overall", descending)
    starts = numbered.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.min("_overall").alias("_start"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return numbered.join(starts, same).select(*df.columns, (F.col("_overall") - F.col("_start") + 1).alias(into))
