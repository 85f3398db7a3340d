"""A stored layout in which lines lie beside their orders, month by month.

Orders and lines are partitioned by the month of the order and bucketed by ``order_id``, so a
join or an aggregation by order needs no exchange of either table, and a range of dates reads
the months it touches. Both tables are external tables over plain Parquet files; a session that
did not write them registers them again from the layout's own record.

An order is never cut in two by its bucket. Where one order holds more lines than a bucket should,
the tables are written without buckets, and the shuffle join, which AQE can split, stays in place.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sources.tables import NATIVE, Tables, native_tables

#: The partition column of orders and lines: the first day of the order's month, null without one.
MONTH = "order_month"
_RECORD = T.StructType([T.StructField("buckets", T.IntegerType())])
_STORED = ("orders", "lines")
#: Files of a month without buckets, at most.
FILES = 16


def _named(folder: str, name: str, buckets: int) -> str:
    digest = hashlib.sha256(f"{folder.rstrip('/')}:{buckets}".encode()).hexdigest()[:16]
    return f"tallyhouse_{digest}_{name}"


def fitting_buckets(lines: DataFrame, buckets: int) -> int:
    """``buckets``, or 0 where an order would more than double the bucket that it falls into."""
    per_order = lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("rows"))
    most, total = per_order.agg(F.max("rows"), F.sum("rows")).first()
    return buckets if most is None or most * buckets <= max(total, 16 * buckets) else 0


def write_layout(tables: Tables, folder: str, buckets: int = 64) -> int:
    """Write the five tables to ``folder``, which must not exist; returns the buckets used (0: none).

    Choose the buckets so that one of them, over all months, fits a task: lines / 100 million or so.
    """
    spark = tables.orders.sparkSession
    buckets = fitting_buckets(tables.lines, buckets) if buckets else 0
    typed = {
        name: getattr(tables, name).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
        )
        for name, schema in NATIVE.items()
    }
    month = F.trunc("order_date", "month").alias(MONTH)
    stored = {
        "orders": typed["orders"].select("*", month),
        "lines": typed["lines"].join(typed["orders"].select("order_id", month), "order_id", "left"),
    }
    for name, frame in typed.items():
        if name not in _STORED:
            frame.write.parquet(f"{folder}/{name}")
            continue
        path = f"{folder}/{name}"
        if buckets:
            # dealt as the buckets are, so that a task writes one file for each month of its bucket
            writer = stored[name].repartition(buckets, "order_id").write.partitionBy(MONTH)
            writer = writer.bucketBy(buckets, "order_id").sortBy("order_id").option("path", path)
            writer.format("parquet").mode("errorifexists").saveAsTable(_named(folder, name, buckets))
        else:
            # a month may be large, so it is dealt over several tasks
            keys = ("order_id", "product_id") if name == "lines" else ("order_id",)
            part = F.pmod(F.xxhash64(*keys), F.lit(FILES))
            stored[name].repartition(MONTH, part).write.partitionBy(MONTH).parquet(path)
    spark.createDataFrame([(buckets,)], _RECORD).coalesce(1).write.json(f"{folder}/layout")
    return buckets


def load_layout(spark: SparkSession, folder: str) -> Tables:
    """The tables that ``write_layout`` wrote, in this session or another."""
    (buckets,) = spark.read.schema(_RECORD).json(f"{folder}/layout").first()

    def opened(name: str) -> DataFrame:
        schema = T.StructType([*NATIVE[name].fields, T.StructField(MONTH, T.DateType())])
        if not buckets:
            return spark.read.schema(schema).parquet(f"{folder}/{name}")
        known = _named(folder, name, buckets)
        if not spark.catalog.tableExists(known):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
            place = f"{folder}/{name}".replace("'", "\\'")
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {known} ({columns}) USING parquet PARTITIONED BY ({MONTH}) "
                f"CLUSTERED BY (order_id) SORTED BY (order_id) INTO {buckets} BUCKETS LOCATION '{place}'"
            )
            spark.catalog.recoverPartitions(known)
        return spark.table(known)

    def tables(start=None) -> Tables:
        def open_table(name: str) -> DataFrame:
            columns = NATIVE[name].names
            if name not in _STORED:
                return spark.read.schema(NATIVE[name]).parquet(f"{folder}/{name}")
            frame = opened(name)
            if start is not None:
                frame = frame.where(F.col(MONTH) >= F.trunc(start, "month"))
            return frame.select(*columns)

        return native_tables(open_table, lambda: open_table("lines"), tables)

    return tables()
