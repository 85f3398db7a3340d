"""Stored sums that reports take instead of raw lines.

Two tables, partitioned by the month of the order, hold sums that may be added up further:

    order_sums      order_id, all_quantity, priced_lines, quantity, cents
    product_months  product_id, is_returned, ordered, quantity

The first has a row per order, the second one per product, return flag and month, so a report about
orders reads no line and no product, and one about products reads no line and no order. Late orders
are taken in by writing their months again; the other months' files stay as they are. Order keys are unique,
which ``check_integrity`` tells.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators import facts
from tallyhouse.sources.tables import Tables, from_frames

#: The partition column: the first day of the order's month, null for lines without a dated order.
MONTH = "order_month"
ROLLUPS = {
    "order_sums": "order_id long, all_quantity long, priced_lines long, quantity long, cents long",
    "product_months": "product_id long, is_returned boolean, ordered boolean, quantity long",
}


def _order_sums(t: Tables) -> DataFrame:
    # both by order, so they meet without another shuffle
    every = facts.order_quantities(t).withColumnRenamed("quantity", "all_quantity")
    priced = (
        facts.priced_lines(t)
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("priced_lines"),
            F.sum("quantity").alias("quantity"),
            F.sum("cents").alias("cents"),
        )
    )
    months = t.orders.select("order_id", F.trunc("order_date", "month").alias(MONTH))
    return every.join(priced, "order_id", "left").join(months, "order_id", "left")


def _product_months(t: Tables) -> DataFrame:
    orders = t.orders.select(
        "order_id", "is_returned", F.lit(True).alias("ordered"), F.trunc("order_date", "month").alias(MONTH)
    )
    found = t.lines.where(F.col("product_id").isNotNull()).join(orders, "order_id", "left")
    return found.groupBy(
        "product_id", "is_returned", F.coalesce("ordered", F.lit(False)).alias("ordered"), MONTH
    ).agg(F.sum(F.col("quantity").cast("long")).alias("quantity"))


def _write(t: Tables, folder: str, **how: str) -> None:
    for name, frame in (("order_sums", _order_sums(t)), ("product_months", _product_months(t))):
        columns = T.StructType.fromDDL(ROLLUPS[name]).names
        writer = frame.select(*columns, MONTH).write.partitionBy(MONTH).options(**how)
        writer.mode("overwrite" if how else "errorifexists").parquet(f"{folder}/{name}")


def write_rollups(tables: Tables, folder: str) -> None:
    """Build both tables from all orders and lines, in a folder that does not exist."""
    _write(tables, folder)


def refresh_rollups(tables: Tables, folder: str, months: Iterable[date]) -> None:
    """Build the given months again (any day names its month); other months are not touched.

    Name the old and the new month of an order whose date has changed. A month that has lost its last
    order keeps its sums, and lines without a dated order are taken in by ``write_rollups`` only.
    """
    firsts = sorted({day.replace(day=1) for day in months})
    if not firsts:
        return
    orders = tables.orders.where(F.trunc("order_date", "month").isin(firsts))
    lines = tables.lines.join(orders.select("order_id"), "order_id", "left_semi")
    frames = {name: getattr(tables, name) for name in ("regions", "customers", "products")}
    _write(from_frames(orders=orders, lines=lines, **frames), folder, partitionOverwriteMode="dynamic")


def with_rollups(tables: Tables, folder: str) -> Tables:
    """The same tables, whose reports read the stored sums where these are enough."""
    spark: SparkSession = tables.orders.sparkSession

    def opener(name: str):
        schema = T.StructType([*T.StructType.fromDDL(ROLLUPS[name]), T.StructField(MONTH, T.DateType())])
        return lambda: spark.read.schema(schema).parquet(f"{folder}/{name}")

    return tables.also(**{name: opener(name) for name in ROLLUPS})
