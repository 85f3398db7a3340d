"""Money and ratio columns.

Money travels as whole cents, so sums are exact and independent of task order. What
one line, order or customer holds is a LONG, cheap in generated code (up to 9.2e16
in currency; beyond that ANSI mode raises an error). A product's revenue and every
total above that grain is a DECIMAL(38,0), so no report's total is bounded by 64
bits. Ratios are rounded half-up to two
decimals in whole-number arithmetic, so no binary fraction can tip a half-cent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,2)"
WHOLE = "decimal(38,0)"


def cents(price: Column) -> Column:
    """DECIMAL price with two fraction digits to whole cents."""
    return (price * 100).cast("long")


def money(amount: Column) -> Column:
    """Whole cents to DECIMAL currency."""
    return (amount.cast("decimal(26,0)") * F.lit(0.01).cast("decimal(2,2)")).cast(MONEY)


def ratio2(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator rounded half-up to two decimals, as DOUBLE.

    Both arguments are whole numbers. A zero denominator gives null.
    """
    top = F.abs(numerator.cast(WHOLE))
    bottom = F.abs(F.nullif(denominator.cast(WHOLE), F.lit(0).cast(WHOLE)))
    hundredths = F.call_function("div", top * 200 + bottom, bottom * 2)
    sign = F.when((numerator < 0) != (denominator < 0), -1).otherwise(1)
    return (hundredths * sign).cast("double") / 100


def percent2(part: Column, whole: Column) -> Column:
    """part as a percentage of whole, two decimals."""
    return ratio2(part.cast(WHOLE) * 100, whole)


def money_per(amount: Column, count: Column) -> Column:
    """Currency per item from whole cents and a count, two decimals."""
    return ratio2(amount, count.cast(WHOLE) * 100)


def mean_money(amount: Column, count: Column) -> Column:
    """Unrounded currency per item from whole cents and a count."""
    return amount.cast("double") / F.nullif(count, F.lit(0)).cast("double") / 100


def total(amount: Column) -> Column:
    """Sum of whole cents, wider than a LONG."""
    return F.sum(amount.cast(WHOLE))


def add_where(condition: Column, value: Column) -> Column:
    """Sum of value over the rows that meet the condition; the others add 0."""
    return F.sum(F.when(condition, value).otherwise(0))


def count_where(condition: Column) -> Column:
    """Number of rows that meet the condition."""
    return add_where(condition, F.lit(1)).cast("long")
