"""Calendar columns. Group by the DATE or INT form; format text after the aggregate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def year_of(day: Column) -> Column:
    return F.year(day).cast("long")


def month_of(day: Column) -> Column:
    return F.month(day).cast("long")


def year_month(day: Column) -> Column:
    """2024-09"""
    return F.date_format(day, "yyyy-MM")


def year_month_name(day: Column) -> Column:
    """2024-September"""
    return F.date_format(day, "yyyy-MMMM")


def is_weekend(day: Column) -> Column:
    """True on Sunday (1) and Saturday (7)."""
    return F.dayofweek(day).isin(1, 7)
