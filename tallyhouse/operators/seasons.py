"""Calendar patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import labels
from tallyhouse.functions.periods import is_weekend
from tallyhouse.operators.measures import average_order_value
from tallyhouse.operators.ranking import tile_few


def season_type(months: DataFrame, value: str, month: str) -> DataFrame:
    """Label the calendar months by quartile: first Peak, last Off, else Normal."""
    quartile = F.col("quartile")
    return (
        tile_few(months, value, month, 4, "quartile")
        .withColumn(
            "season_type",
            F.when(quartile == 1, labels.PEAK)
            .when(quartile == 4, labels.OFF_SEASON)
            .otherwise(labels.NORMAL_SEASON),
        )
        .drop("quartile")
    )


def weekday_weekend(orders: DataFrame) -> DataFrame:
    """Cents, orders and average order value on weekdays and at weekends."""
    kind = F.when(is_weekend(F.col("order_date")), labels.WEEKEND).otherwise(labels.WEEKDAY)
    return average_order_value(orders.withColumn("day_type", kind), "day_type")
