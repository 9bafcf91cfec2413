"""Column helpers for values that arrive as loosely typed JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def truthy(value: ColumnOrName, blank: str | int | bool = "") -> Column:
    """The value, or null where it is blank: '' for text, 0 for numbers, False for flags."""
    return F.nullif(_col(value), F.lit(blank))


def first_truthy(*values: ColumnOrName) -> Column:
    """The first text that is neither null nor empty."""
    return F.coalesce(*[truthy(v) for v in values])


def is_truthy(value: ColumnOrName, blank: str | int | bool = "") -> Column:
    return truthy(value, blank).isNotNull()


def full_name(first: ColumnOrName, last: ColumnOrName) -> Column:
    blank = F.lit("")
    return F.trim(F.concat(F.coalesce(_col(first), blank), F.lit(" "), F.coalesce(_col(last), blank)))


def cents(amount: ColumnOrName) -> Column:
    return F.round(_col(amount) * 100).cast("long")


def dollars(amount_cents: ColumnOrName) -> Column:
    """Whole cents become a decimal fraction once, after every sum is done."""
    return _col(amount_cents) / F.lit(100)


def percent_of(part: ColumnOrName, whole: ColumnOrName) -> Column:
    return F.round(F.try_divide(_col(part) * F.lit(100.0), _col(whole)), 2)


def header_text(name: str) -> str:
    return name.replace("_", " ").title()
