"""Calendar expressions. All stay inside whole-stage codegen (no string formatting per fact row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """20240315 for 2024-03-15."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def key_to_date(key: Column | str) -> Column:
    """The date a ``date_key`` stands for; lets a query skip the calendar join."""
    key = F.col(key) if isinstance(key, str) else key
    return F.make_date(key_year(key), key_month(key), (key % 100).cast("int"))


def key_year(key: Column) -> Column:
    return F.floor(key / 10000).cast("int")


def key_month(key: Column) -> Column:
    return (F.floor(key / 100) % 100).cast("int")


def month_key(key: Column) -> Column:
    """202403 for 20240315; the storage partition of a fact."""
    return F.floor(key / 100).cast("int")


def iso_weekday(day: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(day) + 1


def fiscal_year(day: Column) -> Column:
    """A fiscal year starts in October, so the date three months on carries its number."""
    return F.year(F.add_months(day, 3))


def fiscal_quarter(day: Column) -> Column:
    shifted = F.add_months(day, 3)
    return F.format_string("FY%d-Q%d", F.year(shifted), F.quarter(shifted))


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole calendar months from one month to another, ignoring the day."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
