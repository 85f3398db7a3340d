"""Concentration of revenue, customer activity, and checks of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import labels
from tallyhouse.functions.numbers import money, percent2, ratio2, total
from tallyhouse.functions.periods import year_month_name
from tallyhouse.operators import facts, segments
from tallyhouse.operators.concentration import bucket_share, long_tail
from tallyhouse.operators.ladder import tile_sums, with_tile
from tallyhouse.operators.measures import rate_where, total_by
from tallyhouse.operators.ranking import tile_few, top_k_with_ties
from tallyhouse.operators.shares import total_of
from tallyhouse.plans.customers import net_spend
from tallyhouse.plans.registry import plan
from tallyhouse.plans.trends import monthly_orders
from tallyhouse.sources.tables import Tables


def _part_of_total(sums: DataFrame) -> DataFrame:
    return sums.select(
        money(F.col("total")).alias("total_revenue"),
        money(F.col("top")).alias("top_revenue"),
        percent2(F.col("top"), F.col("total")).alias("top_percent"),
    )


@plan("q11_01_top_decile_of_customers")
def top_decile_of_customers(t: Tables) -> DataFrame:
    tiles = tile_sums(net_spend(t), "cents", 10)
    top = F.when(F.col("tile") == 1, F.col("total"))
    return _part_of_total(tiles.agg(F.sum("total").alias("total"), F.sum(top).alias("top")))


@plan("q11_02_top_products_share")
def top_products_share(t: Tables, k: int = labels.TOP_K) -> DataFrame:
    products = facts.product_fact(t, facts.NET)
    top = top_k_with_ties(products, "cents", "revenue_rank", k)
    return _part_of_total(
        top.agg(total(F.col("cents")).alias("top")).withColumn(
            "total", total_of(products, "cents")
        )
    )


@plan("q11_03_long_tail_of_products")
def long_tail_of_products(t: Tables, percent: int = labels.PARETO_PERCENT) -> DataFrame:
    return long_tail(facts.product_fact(t, facts.NET), "cents", percent)


@plan("q11_04_order_concentration")
def order_concentration(t: Tables) -> DataFrame:
    tile = F.col("tile")
    kind = (
        F.when(tile == 1, labels.HIGH_ORDERS)
        .when(tile <= 5, labels.MEDIUM_ORDERS)
        .otherwise(labels.LOW_ORDERS)
    )
    shares = bucket_share(facts.order_fact(t, facts.NET), "cents", 10, kind)
    return shares.select(F.col("bucket").alias("order_type"), "share_percent").orderBy(
        F.desc("share_percent")
    )


@plan("q11_05_top_categories_share")
def top_categories_share(t: Tables) -> DataFrame:
    categories = total_by(facts.product_fact(t, facts.NET, "category"), ("category",))
    tiles = tile_few(categories, "cents", "category", 3, "tile")
    top = total(F.when(F.col("tile") == 1, F.col("cents")))
    return tiles.agg(percent2(top, total(F.col("cents"))).alias("top_percent"))


@plan("q12_01_orders_per_customer")
def orders_per_customer(t: Tables) -> DataFrame:
    customers = total_by(facts.orders_of(t), ("customer_id",), ("orders",))
    return customers.agg(
        ratio2(F.sum("orders"), F.count(F.lit(1))).alias("average_orders")
    )


@plan("q12_02_inactive_customers")
def inactive_customers(t: Tables) -> DataFrame:
    known = facts.orders_of(t, facts.NET).where(F.col("customer_id").isNotNull())
    customers = total_by(known, ("customer_id",), ("orders",))
    orders = F.col("orders")
    return rate_where(customers, inactive=orders == 1, active=orders > 1).withColumnRenamed(
        "ids", "customers"
    )


@plan("q12_03_customer_lifecycle", limits=(365, 1460))
def customer_lifecycle(
    t: Tables, limits: tuple[int, int] = labels.GAP_LIMITS
) -> DataFrame:
    return segments.customer_lifecycle(facts.orders_of(t, facts.NET), limits).orderBy(
        F.desc("gap_days"), "customer_id"
    )


@plan("q12_04_highly_active_customers", min_orders=10)
def highly_active_customers(
    t: Tables, min_orders: int = labels.HIGHLY_ACTIVE_ORDERS
) -> DataFrame:
    share = segments.activity_share(segments.customer_activity(t), min_orders)
    return share.select(
        money(F.col("total")).alias("total_revenue"),
        money(F.col("active")).alias("active_revenue"),
        "active_percent",
    )


@plan("q12_05_order_frequency")
def order_frequency(t: Tables) -> DataFrame:
    return monthly_orders(t).select(
        year_month_name(F.col("month_start")).alias("month"), "orders", "growth_percent"
    )


@plan("window_order_deciles")
def order_deciles(t: Tables) -> DataFrame:
    """Global row number and decile of every non-returned order by value, then id."""
    orders = facts.order_fact(t, facts.NET).select("order_id", "cents")
    return with_tile(orders, "cents", "order_id", 10).select(
        "order_id",
        money(F.col("cents")).alias("order_value"),
        "position",
        F.col("tile").alias("decile"),
    )


@plan("fact_order_lines")
def order_lines(t: Tables) -> DataFrame:
    """Every line with its order, product, customer and region."""
    return facts.order_line_fact(t).withColumn("revenue", money(F.col("cents"))).drop("cents")
