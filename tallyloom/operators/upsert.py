"""Newest row per key, and first-seen row per key, as aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.picking import earliest, latest
from tallyloom.functions.values import is_truthy
from tallyloom.session import scratch, stored


def _pick(df: DataFrame, keys: Sequence[str], chooser, by: Sequence[str]) -> DataFrame:
    """Chooses among the other columns; the keys are the group and need no second copy."""
    others = [name for name in df.columns if name not in keys]
    if not others:
        return df.distinct()
    chosen = df.groupBy(*keys).agg(chooser(others, [b for b in by if b not in keys]).alias("_row"))
    return chosen.select(*[F.col(n) if n in keys else F.col(f"_row.{n}") for n in df.columns])


def newest_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per key: the last by the given columns, ties broken by the remaining ones."""
    return _pick(df, keys, latest, by)


def newest_where_repeated(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per whole key, as `newest_per_key`; a row with a blank in its key is nobody's newer version, so all such rows stay.

    Keys are counted first, and only rows whose key comes again are compared; the others stay where they are. Spark broadcasts the
    repeated keys if they are small and otherwise shuffles the rows by key. The rows are read three times, the first time only their keys.
    """
    whole = df.where(reduce(Column.__and__, [is_truthy(k) for k in keys]))
    counted = whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select(*keys)
    repeated = stored(counted, scratch(df.sparkSession, "repeated"))
    again = df.join(repeated, [*keys], "left_semi").select(*df.columns)
    return df.join(repeated, [*keys], "left_anti").select(*df.columns).unionByName(newest_per_key(again, keys, by))


def first_seen(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per key: the first to arrive. (dropDuplicates would keep an arbitrary one.)"""
    return _pick(df, keys, earliest, by)


def seed_missing(table: DataFrame, seeds: DataFrame, key: str) -> DataFrame:
    """The table plus the seed rows whose key it does not have yet."""
    new = seeds.join(table.select(key).distinct(), key, "left_anti")
    return table.unionByName(new.select(*table.columns))


def append_unlisted(listed: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """The list followed by the items that are not on it; repeats within either list stay."""
    new = more.join(listed.select(key).distinct(), key, "left_anti")
    return listed.select(key, F.lit(0).alias("source")).unionByName(new.select(key, F.lit(1).alias("source")))
