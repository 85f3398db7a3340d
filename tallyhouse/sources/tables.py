"""The five logical tables and the two layouts they are read from.

No schema is ever inferred: each read names the physical columns it wants, so
Spark starts no inference job and the scan reads nothing else.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Tables:
    """Logical model: lines -> orders -> customers -> regions, lines -> products.

    regions         region_id, region_name
    customers       customer_id, customer_name, region_id
    customer_names  customer_id, customer_name
    products        product_id, product_name, category, price
    orders          order_id, customer_id, order_date, is_returned
    lines           order_id, product_id, quantity
    line_keys       order_detail_id, or None where the layout holds no such column

    A table is opened when a report first asks for it, so a report lists no files
    of the others. Where a layout reaches the region through another table, name
    look-ups take ``customer_names`` and so skip that join, which Catalyst would
    keep (it removes no unused inner join).
    """

    def __init__(self, since: Callable[[Column], Tables] | None = None, **opener: Callable[[], DataFrame]) -> None:
        self._opener = opener
        self._opened: dict[str, DataFrame] = {}
        self._since = since

    def since(self, start: Column) -> Tables:
        """The tables without what the layout can skip of the time before ``start``.

        A layout by month leaves out older months of orders and lines; others skip
        nothing. Rows of the first month stay, so the date is still to be compared.
        """
        return self if self._since is None else self._since(start)

    def also(self, **opener: Callable[[], DataFrame]) -> Tables:
        """The same tables and further ones, such as stored sums."""
        since = self._since and (lambda start: self._since(start).also(**opener))
        return Tables(since, **(self._opener | opener))

    def has(self, name: str) -> bool:
        return name in self._opener

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._opener:
            raise AttributeError(name)
        if name not in self._opened:
            self._opened[name] = self._opener[name]()
        return self._opened[name]


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


#: Native layout: column name and type of each table.
NATIVE = {
    "regions": _struct(region_id=T.LongType(), region_name=T.StringType()),
    "customers": _struct(
        customer_id=T.LongType(), customer_name=T.StringType(), region_id=T.LongType()
    ),
    "products": _struct(
        product_id=T.LongType(),
        product_name=T.StringType(),
        category=T.StringType(),
        price=T.DecimalType(10, 2),
    ),
    "orders": _struct(
        order_id=T.LongType(),
        customer_id=T.LongType(),
        order_date=T.DateType(),
        is_returned=T.BooleanType(),
    ),
    "lines": _struct(
        order_id=T.LongType(), product_id=T.LongType(), quantity=T.IntegerType()
    ),
}

#: Star layout: the physical columns that are read.
STAR = {
    "region": _struct(r_regionkey=T.IntegerType(), r_name=T.StringType()),
    "nation": _struct(n_nationkey=T.IntegerType(), n_regionkey=T.IntegerType()),
    "customer": _struct(
        c_custkey=T.LongType(), c_name=T.StringType(), c_nationkey=T.IntegerType()
    ),
    "part": _struct(
        p_partkey=T.LongType(),
        p_name=T.StringType(),
        p_type=T.StringType(),
        p_retailprice=T.DoubleType(),
    ),
    "orders": _struct(
        o_orderkey=T.LongType(),
        o_custkey=T.LongType(),
        o_orderstatus=T.StringType(),
        o_orderdate=T.TimestampNTZType(),
    ),
    "lineitem": _struct(
        l_orderkey=T.LongType(), l_partkey=T.LongType(), l_quantity=T.DoubleType()
    ),
}


def from_frames(**frames: DataFrame) -> Tables:
    """Tables over the five frames that already have the logical columns."""
    return native_tables(lambda name: frames[name], lambda: frames["lines"])


def native_tables(
    open_table: Callable[[str], DataFrame],
    open_lines: Callable[[], DataFrame],
    since: Callable[[Column], Tables] | None = None,
) -> Tables:
    """Tables of the native columns; ``open_lines`` opens the lines with all columns of the files."""

    def names() -> DataFrame:
        return open_table("customers").select("customer_id", "customer_name")

    def line_keys() -> DataFrame | None:
        lines = open_lines()
        if "order_detail_id" not in lines.columns:
            return None
        return lines.select(F.col("order_detail_id").cast("long").alias("order_detail_id"))

    return Tables(
        since,
        customer_names=names,
        line_keys=line_keys,
        **{name: partial(open_table, name) for name in NATIVE},
    )


def load_star(spark: SparkSession, folder: str) -> Tables:
    """Read region, nation, customer, part, orders and lineitem Parquet files."""

    def scan(name: str) -> DataFrame:
        return spark.read.schema(STAR[name]).parquet(f"{folder}/{name}.parquet")

    col = F.col

    def regions() -> DataFrame:
        return scan("region").select(
            col("r_regionkey").cast("long").alias("region_id"), col("r_name").alias("region_name")
        )

    def customers() -> DataFrame:
        nation = scan("nation").select(
            "n_nationkey", col("n_regionkey").cast("long").alias("region_id")
        )
        named = scan("customer").join(nation, col("c_nationkey") == col("n_nationkey"))
        return named.select(
            col("c_custkey").alias("customer_id"), col("c_name").alias("customer_name"), "region_id"
        )

    def customer_names() -> DataFrame:
        return scan("customer").select(
            col("c_custkey").alias("customer_id"), col("c_name").alias("customer_name")
        )

    def products() -> DataFrame:
        return scan("part").select(
            col("p_partkey").alias("product_id"),
            col("p_name").alias("product_name"),
            col("p_type").alias("category"),
            col("p_retailprice").cast("decimal(10,2)").alias("price"),
        )

    def orders() -> DataFrame:
        return scan("orders").select(
            col("o_orderkey").alias("order_id"),
            col("o_custkey").alias("customer_id"),
            col("o_orderdate").cast("date").alias("order_date"),
            (col("o_orderstatus") == "F").alias("is_returned"),
        )

    def lines() -> DataFrame:
        return scan("lineitem").select(
            col("l_orderkey").alias("order_id"),
            col("l_partkey").alias("product_id"),
            col("l_quantity").cast("int").alias("quantity"),
        )

    return Tables(
        regions=regions,
        customers=customers,
        customer_names=customer_names,
        products=products,
        orders=orders,
        lines=lines,
        line_keys=lambda: None,
    )


def load_native(spark: SparkSession, folder: str, fmt: str = "parquet") -> Tables:
    """Read ``<folder>/<table>`` for the five native tables.

    ``fmt`` is parquet, orc, json or csv (with a header line). Text formats are
    read as text and cast, so that a malformed value raises an error under ANSI
    mode and a flag may be written true/false or 1/0. CSV files are grouped by their
    header line and read by its names, so files may order their columns differently
    and hold further ones; a file without a needed column is an error.
    """

    def scan(name: str, *more: T.StructField) -> DataFrame:
        schema, path = T.StructType([*NATIVE[name], *more]), f"{folder}/{name}"
        if fmt in ("parquet", "orc"):
            return spark.read.schema(schema).format(fmt).load(path)
        if fmt == "csv":
            raw = _by_header(spark, path, schema, {f.name for f in more})
        else:
            raw = spark.read.schema(_as_text(schema.names)).format(fmt).load(path)
        return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])

    def whole_lines() -> DataFrame:
        path, key = f"{folder}/lines", T.StructField("order_detail_id", T.LongType())
        if fmt in ("parquet", "orc"):
            # the files say what they hold
            return spark.read.format(fmt).load(path)
        if fmt == "csv":
            held = any(key.name in header for header in headers(spark, path).values())
        else:
            first = spark.read.text(path).first()
            held = first is not None and f'"{key.name}"' in first[0]
        return scan("lines", key) if held else scan("lines")

    return native_tables(scan, whole_lines)


def _as_text(names) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _literal(file: str) -> str:
    """A path that is read as it is, not as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", file)


def headers(spark: SparkSession, path: str) -> dict[str, tuple[str, ...]]:
    """The column names in the first line of each CSV file; empty files are left out.

    The files are listed without their content, and each is opened for one line.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = sorted(row[0] for row in listed.select("path").collect())

    def first_line(file: str) -> str | None:
        row = spark.read.text(_literal(file)).first()
        return None if row is None else row[0].removeprefix("\ufeff")

    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(first_line, files))
    return {
        file: tuple(name.strip() for name in next(csv.reader([line])))
        for file, line in zip(files, lines)
        if line
    }


def _by_header(
    spark: SparkSession, path: str, schema: T.StructType, optional: set[str]
) -> DataFrame:
    """CSV files as text, those of one header in one scan; optional columns may be missing."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in headers(spark, path).items():
        groups.setdefault(header, []).append(file)
    if not groups:
        return spark.createDataFrame([], _as_text(schema.names))
    read = spark.read.option("header", True)
    parts = []
    for header, files in sorted(groups.items()):
        raw = read.schema(_as_text(header)).csv([_literal(file) for file in files])
        gone = [F.lit(None).cast("string").alias(c) for c in optional if c not in header]
        parts.append(raw.select(*[c for c in schema.names if c not in optional or c in header], *gone))
    return reduce(DataFrame.unionByName, parts)
