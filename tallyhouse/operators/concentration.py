"""How much of the revenue few customers, orders or products hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import labels
from tallyhouse.functions.numbers import WHOLE, percent2
from tallyhouse.operators.ladder import climb, tile_sums, value_groups, with_order_key
from tallyhouse.operators.shares import contribution_of_few, total_of


def _with_running(keyed: DataFrame) -> DataFrame:
    """_key, rows, total, running (sum from the highest value, ties included), grand_total."""
    groups = value_groups(keyed, "_key")
    return climb(groups, "_key").select(
        "_key",
        "rows",
        "total",
        (F.col("before_total") + F.col("total")).alias("running"),
        total_of(groups, "total").alias("grand_total"),
    )


def _within(percent: int) -> Column:
    return F.col("running").cast(WHOLE) * 100 <= F.col("grand_total").cast(WHOLE) * percent


def pareto_head(
    frame: DataFrame, value: str, percent: int = labels.PARETO_PERCENT
) -> DataFrame:
    """The rows, from the highest value, whose running sum stays within the percentage.

    Adds running, grand_total and running_percent. The row that crosses the line
    and those that tie with it are left out. A null value adds nothing and comes last.
    """
    keyed = with_order_key(frame, value)
    head = (
        _with_running(keyed)
        .where((F.col("grand_total") != 0) & _within(percent))
        .select(
            "_key",
            "running",
            "grand_total",
            percent2(F.col("running"), F.col("grand_total")).alias("running_percent"),
        )
    )
    return keyed.join(head, "_key").drop("_key")


def long_tail(frame: DataFrame, value: str, percent: int = labels.PARETO_PERCENT) -> DataFrame:
    """One row: the percentage of the total held by the rows beyond the line."""
    return (
        _with_running(with_order_key(frame, value))
        .agg(
            F.sum(F.when(~_within(percent), F.col("total"))).alias("tail"),
            F.max("grand_total").alias("grand_total"),
        )
        .select(percent2(F.col("tail"), F.col("grand_total")).alias("tail_percent"))
    )


def bucket_share(frame: DataFrame, value: str, tiles: int, bucket: Column) -> DataFrame:
    """Total and percentage of each bucket of n-tiles by descending value.

    ``bucket`` is an expression over the column ``tile``.
    """
    sums = tile_sums(frame, value, tiles).groupBy(bucket.alias("bucket"))
    return contribution_of_few(sums.agg(F.sum("total").alias("total")), "total")
