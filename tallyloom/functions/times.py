"""Time helpers. All times are zone-free UTC wall-clock times, whatever the session zone is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.values import ColumnOrName, _col


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def epoch() -> Column:
    return moment("1970-01-01 00:00:00")


def from_seconds(seconds: ColumnOrName) -> Column:
    return F.timestamp_add("SECOND", _col(seconds), epoch())


def to_seconds(time: ColumnOrName) -> Column:
    """Whole seconds since 1970, rounded down, also before 1970."""
    micros, million = F.timestamp_diff("MICROSECOND", epoch(), _col(time)), F.lit(1_000_000)
    return ((micros - F.pmod(micros, million)) / million).cast("long")


def month_of(time: ColumnOrName) -> Column:
    return F.trunc(_col(time).cast("date"), "month")


def day_of(time: ColumnOrName) -> Column:
    return _col(time).cast("date")


def elapsed(unit: str, start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole units between two times, cut towards zero; not calendar boundaries crossed."""
    return F.timestamp_diff(unit, _col(start), _col(end))


def months_between_firsts(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Months from one first-of-month date to another."""
    s, e = _col(start), _col(end)
    return ((F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)).cast("long")


def before(as_of: str, **span: int) -> Column:
    return moment(as_of) - F.make_interval(**{unit: F.lit(n) for unit, n in span.items()})


def after(as_of: str, **span: int) -> Column:
    return moment(as_of) + F.make_interval(**{unit: F.lit(n) for unit, n in span.items()})


def printed(seconds: ColumnOrName) -> Column:
    """Unix seconds as 'yyyy-MM-dd HH:mm:ss', or '' where there is no time."""
    s = F.nullif(_col(seconds), F.lit(0))
    return F.coalesce(F.date_format(from_seconds(s), "yyyy-MM-dd HH:mm:ss"), F.lit(""))


def parsed(text: ColumnOrName) -> Column:
    """A time from text. With a zone or an offset it is brought to UTC; without, it is taken as UTC."""
    value = F.trim(_col(text))
    # Through the session's zone and back out of it, so that the zone does not matter.
    zoned = F.convert_timezone(F.current_timezone(), F.lit("UTC"), value.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(value.rlike(r"\d\s*(Z|UTC|GMT|[+-]\d{1,2}:?\d{2})$") & value.contains(":"), zoned).otherwise(
        value.try_cast("timestamp_ntz")
    )
