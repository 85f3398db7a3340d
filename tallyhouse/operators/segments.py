"""Customer values, segments and life cycles.

All are aggregates per customer with a map-side combine; no window sorts the
orders of one customer, so one customer may hold any part of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import labels
from tallyhouse.functions.numbers import WHOLE, add_where, percent2, total
from tallyhouse.operators import facts
from tallyhouse.sources.tables import Tables


def classify(value: Column, bands: Sequence[tuple[str, int, int]], otherwise: str) -> Column:
    """The label of the first (label, low, high) band that holds the value, both ends included."""
    label = F.lit(otherwise)
    for name, low, high in reversed(bands):
        label = F.when(value.between(low, high), name).otherwise(label)
    return label


def spend_segment(spend: Column, limits: tuple[int, int, int] = labels.SPEND_LIMITS) -> Column:
    """Platinum above the first limit, Gold from the second, Silver from the third, else Bronze.

    ``spend`` is in cents, limits in whole currency. Silver ends one unit below
    Gold, so a spend between the two, such as 999.50, is Bronze.
    """
    platinum, gold, silver = (limit * 100 for limit in limits)
    named = classify(
        spend,
        ((labels.GOLD, gold, platinum), (labels.SILVER, silver, gold - 100)),
        labels.BRONZE,
    )
    return F.when(spend > platinum, labels.PLATINUM).otherwise(named)


def customer_value(orders: DataFrame) -> DataFrame:
    """customer_id, cents, orders: spend per customer."""
    return orders.groupBy("customer_id").agg(
        F.sum("cents").alias("cents"), F.sum("orders").alias("orders")
    )


def customer_activity(tables: Tables, returns: str = facts.NET) -> DataFrame:
    """customer_id, orders, cents: orders count with or without lines.

    One aggregate answers both; cents is null for a customer without any line.
    """
    orders = facts.orders_of(tables, returns).join(
        facts.order_values(tables), "order_id", "left"
    )
    return customer_value(orders)


def new_or_repeat(orders: Column) -> Column:
    """New for exactly one order."""
    return F.when(orders == 1, labels.NEW_CUSTOMER).otherwise(labels.REPEAT_CUSTOMER)


def inter_order_gap(orders: DataFrame) -> DataFrame:
    """customer_id, days, gaps: days between consecutive orders, summed.

    The gaps of a customer add up to last date - first date, over one pair less
    than the orders; so no row needs its neighbour.
    """
    return (
        orders.groupBy("customer_id")
        .agg(
            F.min("order_date").alias("first"),
            F.max("order_date").alias("last"),
            F.count("order_date").alias("dated"),
        )
        .where(F.col("dated") > 1)
        .select(
            "customer_id",
            F.datediff("last", "first").cast("long").alias("days"),
            (F.col("dated") - 1).alias("gaps"),
        )
    )


def customer_lifecycle(
    orders: DataFrame, limits: tuple[int, int] = labels.GAP_LIMITS
) -> DataFrame:
    """Orders, last and first date, gap in days and buyer type per customer."""
    short, mid = limits
    gap, count = F.col("gap_days"), F.col("orders")
    return (
        orders.groupBy("customer_id")
        .agg(
            F.sum("orders").alias("orders"),
            F.max("order_date").alias("last_order"),
            F.min("order_date").alias("first_order"),
        )
        .withColumn("gap_days", F.datediff("last_order", "first_order").cast("long"))
        .withColumn(
            "buyer_type",
            F.when((gap == 0) & (count == 1), labels.ONE_TIME)
            .when((gap == 0) & (count > 1), labels.SAME_DAY)
            .when(gap < short, labels.SHORT_TERM)
            .when(gap < mid, labels.MID_TERM)
            .otherwise(labels.LONG_TERM),
        )
    )


def activity_share(
    activity: DataFrame, min_orders: int = labels.HIGHLY_ACTIVE_ORDERS
) -> DataFrame:
    """Total cents, cents of customers with at least min_orders, and the percentage."""
    active = add_where(F.col("orders") >= min_orders, F.col("cents").cast(WHOLE))
    return (
        activity.where(F.col("cents").isNotNull())
        .agg(total(F.col("cents")).alias("total"), active.alias("active"))
        .withColumn("active_percent", percent2(F.col("active"), F.col("total")))
    )
