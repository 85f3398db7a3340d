"""Ranks and tiers (O10-O12). Ranks over all rows of a large input: see ladder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse import labels


def top_k_with_ties(
    frame: DataFrame,
    value: str,
    rank: str,
    k: int = labels.TOP_K,
    within: tuple[str, ...] = (),
) -> DataFrame:
    """The rows whose value is among the k highest distinct values, with dense rank.

    Null is the lowest value: rows without a value have a rank only if fewer than k
    values are known. Only the k values themselves are ranked and broadcast (k rows);
    rows that tie stay where they are, so any number of them may share a value.

    With ``within``, the k highest values of each group (null is a group, too). Every
    task passes on its k highest values of a group at most, so no group is sorted, and
    the k values of all groups meet the rows in a join that a hot value cannot bind to
    one task.
    """
    falling = F.desc_nulls_last("_value")
    if not within:
        best = frame.select(F.col(value).alias("_value")).distinct().orderBy(falling).limit(k)
        ranked = best.withColumn(rank, F.row_number().over(Window.orderBy(falling)).cast("long"))
        same = frame[value].eqNullSafe(ranked["_value"])
        return frame.join(F.broadcast(ranked), same).drop("_value")
    # a struct with a null equals another one, a null does not
    keyed = frame.withColumn("_group", F.struct(*within)).withColumn("_of", F.struct(F.col(value)))
    values = keyed.select("_group", "_of", F.col(value).alias("_value")).distinct()
    place = F.row_number().over(Window.partitionBy("_group").orderBy(falling))
    # compared as it is, a row number is limited before the shuffle
    ranked = values.withColumn("_place", place).where(F.col("_place") <= k)
    return keyed.join(ranked.drop("_value"), ["_group", "_of"]).select(
        *frame.columns, F.col("_place").cast("long").alias(rank)
    )


def sort_few(frame: DataFrame, *keys) -> DataFrame:
    """Sort the rows of a short report in one partition.

    A range-partitioned sort would first run the aggregate below it a second time,
    to sample the keys.
    """
    return frame.repartition(1).sortWithinPartitions(*keys)


def rank_few(
    frame: DataFrame, value: str, rank: str, within: tuple[str, ...] = (), descending: bool = True
) -> DataFrame:
    """Dense rank of the rows of a short report (months, regions, categories)."""
    order = F.desc(value) if descending else F.asc(value)
    window = Window.partitionBy(*within).orderBy(order)
    return frame.withColumn(rank, F.dense_rank().over(window).cast("long"))


def with_extremes(frame: DataFrame, value: str) -> DataFrame:
    """Add ``is_highest`` and ``is_lowest`` to the rows of a short report.

    Ties keep the mark, and one row may have both.
    """
    everything = Window.partitionBy()
    return frame.select(
        "*",
        (F.col(value) == F.max(value).over(everything)).alias("is_highest"),
        (F.col(value) == F.min(value).over(everything)).alias("is_lowest"),
    )


def tier(rank: Column, tiers: tuple[tuple[int, str], ...], otherwise: str) -> Column:
    """The label of the first tier whose last rank is not below the rank."""
    label = F.lit(otherwise)
    for last, name in reversed(tiers):
        label = F.when(rank <= last, name).otherwise(label)
    return label


def tile_few(frame: DataFrame, value: str, tiebreak: str, tiles: int, tile: str) -> DataFrame:
    """n-tile by descending value of the rows of a short report."""
    window = Window.orderBy(F.desc(value), tiebreak)
    return frame.withColumn(tile, F.ntile(tiles).over(window).cast("long"))
