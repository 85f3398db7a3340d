"""Row numbers in the order of strings, without a task that holds a whole group.

Strings have no blocks of a bounded number of values, as numbers have (see ladder). The
rows of a group are dealt into ranges between splitters instead: the names whose hashes
are smallest, which are spread over all names alike and are the same ones whenever a task
runs again. A row's place is its place within the range plus the rows of the ranges before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Splitters; the ranges of n names hold about n / SPLITS names each.
SPLITS = 255


def splitters(frame: DataFrame, name: str, splits: int = SPLITS) -> Column:
    """At most ``splits`` names in ascending order, as a scalar subquery."""
    known = frame.select(F.col(name).alias("_name")).where(F.col("_name").isNotNull()).distinct()
    few = known.orderBy(F.xxhash64("_name"), "_name").limit(splits)
    return few.agg(F.array_sort(F.collect_list("_name"))).scalar()


def with_places(frame: DataFrame, group: str, name: str, place: str, splits: int = SPLITS) -> DataFrame:
    """Add the 1-based place of each row by name, null first, within its (non-null) group.

    Names are unique within a group, or rows of one name are interchangeable.
    """
    at_or_before = F.size(F.filter("_splitters", lambda s: s <= F.col(name)))
    ranged = (
        frame.withColumn("_splitters", splitters(frame, name, splits))
        .withColumn("_range", F.when(F.col(name).isNull(), -1).otherwise(at_or_before))
        .drop("_splitters")
    )
    within = Window.partitionBy(group, "_range").orderBy(name)
    numbered = ranged.withColumn("_within", F.row_number().over(within).cast("long"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranged.groupBy(group, "_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(group, "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    return numbered.join(before, [group, "_range"]).select(
        *frame.columns, (F.col("_before") + F.col("_within")).alias(place)
    )
