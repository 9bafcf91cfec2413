"""One-to-many rows as arrays: one row per parent with the whole list, in a defined order.

The shape is the same whatever the sizes are, and building a plan runs no job. Each task sorts its own items, which may spill, and
gathers them into one sorted run per parent; only runs are shuffled. The task that has all runs of a parent merges them: sorting an
array that consists of sorted runs takes them as they are. So the items of a parent with a third of all rows are sorted by all
tasks that read some of them. A list is one value of one row, as the nested record asks for; reports that need single items or only
their number use `items` or `item_counts`, which never build a list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.picking import array_order, ordered_array
from tallyloom.functions.values import is_truthy


@dataclass(frozen=True)
class Children:
    """Rows to nest: the key of the parent, the fields of an item and the order of the items."""

    name: str
    rows: DataFrame
    key: str
    fields: tuple[str, ...]
    order: tuple[str, ...]
    descending: bool = False

    @property
    def items(self) -> DataFrame:
        """The rows that have a parent; a blank key names nobody."""
        return self.rows.where(is_truthy(self.key))


def runs(child: Children) -> DataFrame:
    """The items, where they are, in the order of keys and arrays inside each task."""
    return child.items.sortWithinPartitions(child.key, *array_order(child.fields, child.order, child.descending))


def nested(child: Children) -> DataFrame:
    """The key and the array of its items."""
    array = ordered_array(child.fields, child.order, child.descending)
    return runs(child).groupBy(child.key).agg(array.alias(child.name))


def item_counts(child: Children) -> DataFrame:
    """The key and the number of its items."""
    return child.items.groupBy(child.key).agg(F.count(F.lit(1)).alias(f"{child.name}_count"))
