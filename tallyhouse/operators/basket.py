"""What an order holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import labels


def category_combinations(lines: DataFrame, id_column: str, item: str) -> DataFrame:
    """Number of ids per alphabetical text of a set of at least two items.

    The set of one id is built as a partial aggregate and is never larger than
    the number of distinct items, however many lines the id has.
    """
    items = F.array_sort(F.collect_set(item))
    return (
        lines.groupBy(id_column)
        .agg(items.alias("items"))
        .where(F.size("items") > 1)
        .groupBy(F.concat_ws(", ", "items").alias("combination"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )


def basket_type(orders: DataFrame) -> DataFrame:
    """Label each order by its quantity and value against the means.

    At least the mean counts as high; value >= sum / n is compared as
    value x n >= sum, in whole numbers.
    """
    wide = "decimal(38,0)"
    means = orders.agg(
        F.struct(
            F.sum("quantity").cast(wide).alias("quantity"),
            F.sum(F.col("cents").cast("decimal(20,0)")).cast(wide).alias("cents"),
            F.count(F.lit(1)).cast("decimal(20,0)").alias("n"),
        )
    ).scalar()
    marked = orders.select("*", means.alias("_all"))
    n = F.col("_all.n")
    large = F.col("quantity").cast("decimal(18,0)") * n >= F.col("_all.quantity")
    dear = F.col("cents").cast("decimal(18,0)") * n >= F.col("_all.cents")
    return marked.withColumn(
        "basket_type",
        F.when(large & dear, labels.HIGH_BOTH)
        .when(large, labels.HIGH_QUANTITY)
        .when(dear, labels.HIGH_VALUE)
        .otherwise(labels.NORMAL_BASKET),
    ).drop("_all")
