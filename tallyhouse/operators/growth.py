"""Change between periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import percent2


def period_growth(
    frame: DataFrame, value: str, order: str, partition: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``previous`` and ``growth_percent`` against the previous present period.

    ``frame`` has one row per period (and partition). Aggregate first: a window
    partition then holds at most one row per month of the calendar.
    """
    earlier = Window.partitionBy(*partition).orderBy(order)
    change = F.col(value) - F.col("previous")
    return frame.withColumn("previous", F.lag(value).over(earlier)).withColumn(
        "growth_percent", percent2(change, F.col("previous"))
    )


def any_decline(frame: DataFrame, id_columns: tuple[str, ...], period: str, value: str) -> DataFrame:
    """The ids with at least one period below the previous present one.

    ``frame`` has one row per id and period.
    """
    earlier = Window.partitionBy(*id_columns).orderBy(period)
    return (
        frame.withColumn("previous", F.lag(value).over(earlier))
        .where(F.col(value) < F.col("previous"))
        .select(*id_columns)
        .distinct()
    )
