"""Facts (O3): lines joined with their order, product, customer and region.

Two shapes keep joins and shuffles small on large inputs:

* sums by product never touch a price until the lines are summed per product;
* everything about whole orders starts from one row per order, so the orders
  table and the customer tables only ever meet pre-aggregated rows with at most
  one row per key, however many lines or orders one key holds.

Where lines must meet products or orders at line grain (a category or a date is
needed), the join feeds another shuffle, which leaves AQE free to split a hot
product or a hot order over many tasks.

No broadcast is forced: Catalyst and AQE broadcast a side only when its size is
under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import WHOLE, cents, total
from tallyhouse.sources.tables import Tables

ALL, NET, RETURNED = "all", "net", "returned"


def by_returns(frame: DataFrame, returns: str) -> DataFrame:
    """Keep all, the non-returned or the returned orders; a null flag is neither."""
    if returns == NET:
        return frame.where(~F.col("is_returned"))
    if returns == RETURNED:
        return frame.where(F.col("is_returned"))
    if returns != ALL:
        raise ValueError(f"returns must be all, net or returned, not {returns!r}")
    return frame


def orders_of(tables: Tables, returns: str = ALL) -> DataFrame:
    """Orders with ``orders`` = 1 and ``returned`` = 1/0 as addable counts."""
    flag = F.when(F.col("is_returned"), 1).otherwise(0).cast("long")
    return by_returns(tables.orders, returns).select(
        "*", F.lit(1).cast("long").alias("orders"), flag.alias("returned")
    )


def _quantity() -> Column:
    return F.col("quantity").cast("long")


def priced_lines(tables: Tables, *product_columns: str) -> DataFrame:
    """Lines with ``cents`` = quantity x price, and the product columns named."""
    prices = tables.products.select(
        "product_id", cents(F.col("price")).alias("price_cents"), *product_columns
    )
    return tables.lines.join(prices, "product_id").select(
        "order_id",
        "product_id",
        _quantity().alias("quantity"),
        (_quantity() * F.col("price_cents")).alias("cents"),
        *product_columns,
    )


def order_line_fact(
    tables: Tables, returns: str = ALL, columns: tuple[str, ...] | None = None
) -> DataFrame:
    """One row per line (O3), joining only the tables the wanted columns need.

    Orders meet customers and regions before they meet lines, so those joins shuffle orders, not lines.

    Columns: order_id, product_id, quantity, cents, product_name, category,
    customer_id, order_date, is_returned, customer_name, region_id, region_name.
    """
    from_product = ("product_name", "category")
    from_order = ("customer_id", "order_date", "is_returned")
    from_customer = ("customer_name", "region_id", "region_name")
    wanted = columns or (
        "order_id", "product_id", "quantity", "cents",
        *from_product, *from_order, *from_customer,
    )

    fact = tables.lines.select("order_id", "product_id", _quantity().alias("quantity"))
    if returns != ALL or any(c in wanted for c in from_order + from_customer):
        sold = by_returns(tables.orders, returns)
        if "region_id" in wanted or "region_name" in wanted:
            sold = sold.join(tables.customers, "customer_id")
        elif "customer_name" in wanted:
            sold = sold.join(tables.customer_names, "customer_id")
        if "region_name" in wanted:
            sold = sold.join(tables.regions, "region_id")
        fact = fact.join(sold, "order_id")
    if any(c in wanted for c in (*from_product, "cents")):
        prices = tables.products.withColumn("price_cents", cents(F.col("price")))
        fact = fact.join(prices, "product_id").withColumn(
            "cents", F.col("quantity") * F.col("price_cents")
        )
    return fact.select(*wanted)


def order_values(tables: Tables) -> DataFrame:
    """order_id, quantity, cents: one row per order that has lines."""
    if tables.has("order_sums"):
        return tables.order_sums.where("priced_lines > 0").select("order_id", "quantity", "cents")
    return _sums(priced_lines(tables), "order_id")


def order_quantities(tables: Tables) -> DataFrame:
    """order_id, quantity: no product is read."""
    if tables.has("order_sums"):
        return tables.order_sums.select("order_id", F.col("all_quantity").alias("quantity"))
    return tables.lines.groupBy("order_id").agg(F.sum(_quantity()).alias("quantity"))


def order_fact(tables: Tables, returns: str = ALL) -> DataFrame:
    """One row per order with lines: the order's columns, quantity and cents."""
    return order_values(tables).join(orders_of(tables, returns), "order_id")


def order_category_fact(tables: Tables, returns: str = ALL) -> DataFrame:
    """One row per order and category in it, so rows count distinct orders."""
    per_order = _sums(priced_lines(tables, "category"), "order_id", "category")
    return per_order.join(orders_of(tables, returns), "order_id")


def order_categories(tables: Tables, returns: str = ALL) -> DataFrame:
    """One row per order and category in it, without sums: the orders are shuffled once.

    An order holds its distinct categories, at most as many as the product table has;
    a null category is one of them.
    """
    categories = tables.products.select("product_id", F.struct("category").alias("kind"))
    per_order = (
        tables.lines.join(categories, "product_id")
        .groupBy("order_id")
        .agg(F.collect_set("kind").alias("kinds"))
    )
    return (
        per_order.join(orders_of(tables, returns), "order_id")
        .withColumn("kind", F.explode("kinds"))
        .select("order_id", "kind.category", "customer_id", "orders", "returned")
    )


def order_product_fact(tables: Tables, returns: str = ALL) -> DataFrame:
    """One row per order and product in it, so rows count distinct orders."""
    per_order = tables.lines.groupBy("order_id", "product_id").agg(
        F.sum(_quantity()).alias("quantity")
    )
    return per_order.join(orders_of(tables, returns), "order_id")


def product_quantities(tables: Tables, returns: str = ALL) -> DataFrame:
    """product_id, quantity: one row per product with such lines."""
    if tables.has("product_months"):
        return _rolled(tables, returns).groupBy("product_id").agg(F.sum("quantity").alias("quantity"))
    lines = tables.lines.where(F.col("product_id").isNotNull())
    if returns != ALL:
        lines = lines.join(by_returns(tables.orders, returns), "order_id")
    return lines.groupBy("product_id").agg(F.sum(_quantity()).alias("quantity"))


def _rolled(tables: Tables, returns: str) -> DataFrame:
    """The stored sums of products; only orders that are there have a flag to tell."""
    sums = tables.product_months
    return sums if returns == ALL else by_returns(sums.where("ordered"), returns)


def product_months(tables: Tables, returns: str = ALL) -> DataFrame:
    """product_id, month_start, quantity: one row per product and month of dated orders."""
    if tables.has("product_months"):
        months = _rolled(tables, returns).where("ordered").withColumnRenamed("order_month", "month_start")
    else:
        lines = order_line_fact(tables, returns, ("product_id", "order_date", "quantity"))
        months = lines.where(F.col("product_id").isNotNull()).select(
            "product_id", F.trunc("order_date", "month").alias("month_start"), "quantity"
        )
    return months.groupBy("product_id", "month_start").agg(F.sum("quantity").alias("quantity"))


def with_product(tables: Tables, quantities: DataFrame, *columns: str) -> DataFrame:
    """Add product columns and cents to rows that hold a product and a quantity.

    The price never varies, so sum(quantity) x price = sum(quantity x price). One
    product may hold most of a large total, so its cents are wider than a LONG.
    """
    products = tables.products.select(
        "product_id", cents(F.col("price")).alias("price_cents"), *columns
    )
    return (
        quantities.join(products, "product_id")
        .withColumn("cents", (F.col("quantity").cast("decimal(19,0)") * F.col("price_cents")).cast(WHOLE))
        .drop("price_cents")
    )


def product_fact(tables: Tables, returns: str = ALL, *columns: str) -> DataFrame:
    """One row per product: product_id, quantity, cents and the columns named."""
    return with_product(tables, product_quantities(tables, returns), *columns)


def customer_regions(tables: Tables) -> DataFrame:
    """customer_id, region_id, region_name."""
    return tables.customers.join(tables.regions, "region_id").select(
        "customer_id", "region_id", "region_name"
    )


def regional(
    tables: Tables,
    orders: DataFrame,
    measures: tuple[str, ...],
    keys: tuple[str, ...] = (),
    region: tuple[str, ...] = ("region_name",),
) -> DataFrame:
    """Sums by region (and keys) of rows that carry a customer_id.

    Rows are first summed per customer, so a customer with a large part of all
    orders reaches the customer join as one row.
    """
    per_customer = orders.groupBy("customer_id", *keys).agg(
        *[F.sum(m).alias(m) for m in measures]
    )
    return (
        per_customer.join(customer_regions(tables), "customer_id")
        .groupBy(*region, *keys)
        .agg(*[(total(F.col(m)) if m == "cents" else F.sum(m)).alias(m) for m in measures])
    )


def _sums(frame: DataFrame, *keys: str) -> DataFrame:
    return frame.groupBy(*keys).agg(
        F.sum("quantity").alias("quantity"), F.sum("cents").alias("cents")
    )
