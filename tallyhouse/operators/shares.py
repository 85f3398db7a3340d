"""Parts of a total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse import labels
from tallyhouse.functions.numbers import WHOLE, percent2, total as wide_total


def total_of(frame: DataFrame, value: str):
    """The sum of a column as a scalar subquery: one number, no join, no window."""
    return frame.agg(wide_total(F.col(value))).scalar()


def contribution(
    frame: DataFrame, value: str, whole: DataFrame | None = None, name: str = "share_percent"
) -> DataFrame:
    """Add each row's percentage of the total of ``whole`` (default: of frame).

    For inputs of any size.
    """
    total = total_of(frame if whole is None else whole, value)
    return frame.withColumn(name, percent2(F.col(value), total))


def contribution_of_few(
    frame: DataFrame, value: str, within: tuple[str, ...] = (), name: str = "share_percent"
) -> DataFrame:
    """The same for a short report (regions, categories, segments), also within groups.

    One window is cheaper than a subquery there; its partition holds the report.
    """
    total = wide_total(F.col(value)).over(Window.partitionBy(*within))
    return frame.withColumn(name, percent2(F.col(value), total))


def price_or_volume(frame: DataFrame) -> DataFrame:
    """Quantity and revenue percentages of a short report, and which is larger.

    The shares are compared before rounding, as q x R against r x Q.
    """
    everything = Window.partitionBy()
    whole = frame.select(
        "*",
        F.sum("quantity").over(everything).alias("_quantity"),
        wide_total(F.col("cents")).over(everything).alias("_cents"),
    )
    by_price = F.col("cents").cast(WHOLE) * F.col("_quantity").cast("decimal(20,0)")
    by_volume = F.col("_cents").cast(WHOLE) * F.col("quantity").cast("decimal(20,0)")
    comparable = (F.col("_quantity") != 0) & (F.col("_cents") != 0)
    return whole.select(
        *frame.columns,
        percent2(F.col("quantity"), F.col("_quantity")).alias("quantity_percent"),
        percent2(F.col("cents"), F.col("_cents")).alias("revenue_percent"),
        F.when(comparable & (by_price > by_volume), labels.PRICE_DRIVEN)
        .when(comparable & (by_price < by_volume), labels.VOLUME_DRIVEN)
        .otherwise(labels.BALANCED)
        .alias("category_type"),
    )
