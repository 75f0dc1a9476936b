"""Date semantics of the reports as Column helpers and literal periods.

Reporting periods are Python dates computed on the driver from an explicit ``as_of``, so
they reach the scan as literals and are pushed down. Nothing here reads the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value)[:10])


# ---- literal periods -------------------------------------------------------------------

def month_floor(day) -> dt.date:
    return as_date(day).replace(day=1)


def add_months(day, n: int) -> dt.date:
    """First day of the month ``n`` months away from the month of ``day``."""
    day = as_date(day)
    index = day.year * 12 + day.month - 1 + n
    return dt.date(index // 12, index % 12 + 1, 1)


def report_month(as_of, lag_days: int = 3) -> tuple[dt.date, dt.date]:
    """First and last day of the month that holds ``as_of - lag_days``."""
    start = month_floor(as_date(as_of) - dt.timedelta(days=lag_days))
    return start, add_months(start, 1) - dt.timedelta(days=1)


def prev_month(as_of) -> tuple[dt.date, dt.date]:
    """Previous full month as a half-open range ``[first, next first)``."""
    return add_months(as_of, -1), month_floor(as_of)


def last_fri_week(as_of) -> tuple[dt.date, dt.date]:
    """The seven days ``[Friday, next Friday)`` that end before the latest Friday <= as_of."""
    day = as_date(as_of)
    friday = day - dt.timedelta(days=(day.weekday() - 4) % 7)
    return friday - dt.timedelta(days=7), friday


def restate_prev_month(as_of, days: int = 7) -> dt.date | None:
    """First day of the previous month during the first ``days`` days of a month, else None."""
    day = as_date(as_of)
    return add_months(day, -1) if day.day <= days else None


# ---- columns ---------------------------------------------------------------------------

def month_diff(start: Column, end: Column) -> Column:
    """Month boundaries crossed from ``start`` to ``end`` (not whole elapsed months)."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def day_diff(start: Column, end: Column) -> Column:
    """Midnights crossed from ``start`` to ``end``."""
    return F.datediff(end.cast("date"), start.cast("date"))


def month_start(col: Column) -> Column:
    return F.trunc(col.cast("date"), "MM")


def month_end(col: Column) -> Column:
    return F.last_day(col.cast("date"))


def to_date_key(col: Column) -> Column:
    """Date -> integer ``yyyymmdd``."""
    day = col.cast("date")
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def from_date_key(col: Column) -> Column:
    """Integer ``yyyymmdd`` -> date."""
    return F.to_date(col.cast("string"), "yyyyMMdd")


def iso_weekday(col: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(col.cast("date")) + 1


def day_name(col: Column) -> Column:
    return F.date_format(col, "E")


def month_label(col: Column, style: str = "MMM-yy") -> Column:
    """Month label, for example ``Jan-24`` (``MMM-yy``) or ``24-Jan`` (``yy-MMM``)."""
    return F.date_format(col, style)


def month_sort_key(col: Column) -> Column:
    """Integer ``yyyymm`` by which month labels are ordered."""
    return F.year(col) * 100 + F.month(col)


# Output patterns of the numbered conversion styles in use.
CONVERT_STYLES = {
    23: "yyyy-MM-dd",
    102: "yyyy.MM.dd",
    106: "dd MMM yyyy",
    110: "MM-dd-yyyy",
    112: "yyyyMMdd",
    120: "yyyy-MM-dd HH:mm:ss",
}


def convert_date(col: Column, style: int) -> Column:
    return F.date_format(col, CONVERT_STYLES[style])


def seconds_of_day(col: Column) -> Column:
    """Time of day as an integer (Spark has no TIME column type enabled by default)."""
    return F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)
