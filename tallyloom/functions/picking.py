"""Choosing one row per group, and ordered arrays, as aggregates.

A 'latest row' is an aggregate here and not a ranked window: every task first reduces its own rows
to one per key, so a key that holds a third of the data sends a handful of rows over the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def latest(values: Sequence[str], by: Sequence[str | Column]) -> Column:
    """The row that is last by the given keys, as a struct of the keys and the other values.

    The row itself is what gets compared, so it is kept once. A null key sorts lowest and does not
    hide its row, and ties are settled by the remaining values.
    """
    return F.max(_sortable(values, by))


def earliest(values: Sequence[str], by: Sequence[str | Column]) -> Column:
    return F.min(_sortable(values, by))


def _sortable(values: Sequence[str], by: Sequence[str | Column]) -> Column:
    return F.struct(*by, *[v for v in values if v not in [b for b in by if isinstance(b, str)]])


def array_order(values: Sequence[str], by: Sequence[str], descending: bool) -> list[Column]:
    """The order of the items of `ordered_array`, for sorting rows."""
    names = [*by, *[v for v in values if v not in by]]
    return [F.col(x).desc_nulls_last() if descending else F.col(x).asc_nulls_first() for x in names]


def active_first(status: str | Column = "status") -> Column:
    """Sorts above everything else when the status is active."""
    status = F.col(status) if isinstance(status, str) else status
    return F.coalesce(status == "active", F.lit(False)).alias("is_active")


def ordered_array(values: Sequence[str], by: Sequence[str], descending: bool) -> Column:
    """All rows of the group as structs, sorted by the keys and then by the other values.

    Keys that are values too come first in the struct, which then sorts as it is. Other keys are
    taken off again after sorting.
    """
    items = F.sort_array(F.collect_list(_sortable(values, by)), asc=not descending)
    if set(by) <= set(values):
        return items
    return F.transform(items, lambda x: F.struct(*[x[v].alias(v) for v in values]))
