"""Totals, averages and rates by any keys.

Inputs carry addable measures (quantity, cents, orders, returned), so every
operator here is one aggregate with a map-side combine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import (
    WHOLE, add_where, count_where, mean_money, money, money_per, percent2, ratio2, total,
)


def total_by(
    frame: DataFrame, keys: tuple = (), measures: tuple[str, ...] = ("cents",)
) -> DataFrame:
    """Sum the measures, over all rows or by keys (names or aliased columns); cents are summed wide."""
    sums = [total(F.col(m)) if m == "cents" else F.sum(m) for m in measures]
    return frame.groupBy(*keys).agg(*[s.alias(m) for s, m in zip(sums, measures)])


def revenue_by(frame: DataFrame, *keys: str) -> DataFrame:
    """Total revenue by keys."""
    return total_by(frame, keys).select(*keys, money(F.col("cents")).alias("revenue"))


def gross_net_returned(frame: DataFrame, *keys: str) -> DataFrame:
    """Gross, net and returned cents, and the returned part in percent.

    A null flag counts in gross only.
    """
    flag, cents = F.col("is_returned"), F.col("cents").cast(WHOLE)
    return (
        frame.groupBy(*keys)
        .agg(
            F.sum(cents).alias("gross"),
            add_where(~flag, cents).alias("net"),
            add_where(flag, cents).alias("returned"),
        )
        .withColumn("returned_percent", percent2(F.col("returned"), F.col("gross")))
    )


def average_order_value(orders: DataFrame, *keys: str, rounded: bool = True) -> DataFrame:
    """cents, orders and average_order_value by keys of one-row-per-order input."""
    average = money_per if rounded else mean_money
    return total_by(orders, keys, ("cents", "orders")).withColumn(
        "average_order_value", average(F.col("cents"), F.col("orders"))
    )


def average_order_size(orders: DataFrame, *keys: str) -> DataFrame:
    """quantity, orders and average_items by keys of one-row-per-order input."""
    return total_by(orders, keys, ("quantity", "orders")).withColumn(
        "average_items", ratio2(F.col("quantity"), F.col("orders"))
    )


def return_rate(frame: DataFrame, *keys: str) -> DataFrame:
    """Returned orders, orders and the rate in percent.

    ``frame`` has one row per distinct order of a group, or sums of such rows.
    """
    return (
        frame.groupBy(*keys)
        .agg(
            F.sum("returned").alias("returned_orders"), F.sum("orders").alias("total_orders")
        )
        .withColumn(
            "return_rate_percent", percent2(F.col("returned_orders"), F.col("total_orders"))
        )
    )


def rate_where(frame: DataFrame, **conditions) -> DataFrame:
    """Rows, rows that meet each condition and the percentages.

    ``frame`` has one row per distinct id; columns are ids, <name>, <name>_percent.
    """
    counted = frame.agg(
        F.count(F.lit(1)).alias("ids"),
        *[count_where(condition).alias(name) for name, condition in conditions.items()],
    )
    return counted.select(
        "*",
        *[percent2(F.col(name), F.col("ids")).alias(f"{name}_percent") for name in conditions],
    )
