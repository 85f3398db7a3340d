"""Returns, refunds and order status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import labels
from tallyhouse.functions.numbers import add_where, cents, count_where, money, percent2
from tallyhouse.functions.periods import month_start, year_month_name
from tallyhouse.operators import facts, segments
from tallyhouse.operators.measures import gross_net_returned, return_rate
from tallyhouse.operators.ranking import sort_few
from tallyhouse.plans.registry import plan
from tallyhouse.sources.tables import Tables

RATE = ("returned_orders", "total_orders", "return_rate_percent")


@plan("q06_01_return_rate_by_category")
def return_rate_by_category(t: Tables) -> DataFrame:
    return return_rate(facts.order_categories(t), "category").transform(
        sort_few, F.desc("return_rate_percent")
    )


@plan("q06_02a_return_rate_by_region")
def return_rate_by_region(t: Tables) -> DataFrame:
    located = facts.regional(t, facts.orders_of(t), ("returned", "orders"))
    return return_rate(located, "region_name").transform(sort_few, F.desc("return_rate_percent"))


@plan("q06_02b_return_rate_by_region_and_category")
def return_rate_by_region_and_category(t: Tables) -> DataFrame:
    region = ("region_id", "region_name")
    located = facts.regional(
        t, facts.order_categories(t), ("returned", "orders"), ("category",), region
    )
    return return_rate(located, *region, "category").transform(
        sort_few, F.desc("return_rate_percent")
    )


@plan("q06_03_frequent_returners", at_least=8)
def frequent_returners(t: Tables, at_least: int = labels.FREQUENT_RETURNS) -> DataFrame:
    rates = return_rate(facts.orders_of(t), "customer_id")
    frequent = rates.where(F.col("returned_orders") >= at_least)
    return (
        frequent.join(t.customer_names, "customer_id")
        .select("customer_id", "customer_name", *RATE)
        .orderBy(F.desc("return_rate_percent"), "customer_id")
    )


@plan("q06_04_revenue_lost")
def revenue_lost(t: Tables) -> DataFrame:
    gross, returned = F.col("gross"), F.col("returned")
    return gross_net_returned(facts.order_fact(t)).select(
        money(gross).alias("total_revenue"),
        money(returned).alias("revenue_loss"),
        money(gross - returned).alias("net_revenue"),
        F.col("returned_percent").alias("loss_percent"),
    )


@plan("q06_05_return_impact_by_product")
def return_impact_by_product(t: Tables) -> DataFrame:
    # quantities are split by flag and summed per product before a price is looked up
    sold = (
        facts.order_line_fact(t, facts.ALL, ("product_id", "quantity", "is_returned"))
        .groupBy("product_id")
        .agg(
            F.sum("quantity").alias("quantity"),
            add_where(F.col("is_returned"), F.col("quantity")).alias("returned"),
        )
    )
    prices = t.products.select(
        "product_id", "product_name", cents(F.col("price")).alias("price_cents")
    )
    # one product may go beyond 64 bits
    returned = F.col("returned").cast("decimal(19,0)") * F.col("price_cents")
    total = F.col("quantity").cast("decimal(19,0)") * F.col("price_cents")
    return (
        sold.join(prices, "product_id")
        .select(
            "product_id",
            "product_name",
            money(returned).alias("returned_revenue"),
            money(total).alias("total_revenue"),
            percent2(returned, total).alias("returned_percent"),
        )
        .orderBy(F.desc("returned_percent"), "product_id")
    )


@plan("q06_06_return_rate_of_new_and_repeat")
def return_rate_of_new_and_repeat(t: Tables) -> DataFrame:
    customers = (
        facts.orders_of(t)
        .where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.sum("orders").alias("orders"), F.sum("returned").alias("returned"))
    )
    typed = customers.withColumn("customer_type", segments.new_or_repeat(F.col("orders")))
    return return_rate(typed, "customer_type").transform(sort_few, F.desc("return_rate_percent"))


def _status(orders: DataFrame, *keys) -> DataFrame:
    """total_orders, completed_orders, returned_orders; an unflagged order is only in the total."""
    return orders.groupBy(*keys).agg(
        F.count("order_id").alias("total_orders"),
        count_where(~F.col("is_returned")).alias("completed_orders"),
        count_where(F.col("is_returned")).alias("returned_orders"),
    )


def _status_percents():
    total = F.col("total_orders")
    return (
        percent2(F.col("completed_orders"), total).alias("completion_percent"),
        percent2(F.col("returned_orders"), total).alias("return_percent"),
    )


@plan("q08_01_orders_by_status")
def orders_by_status(t: Tables) -> DataFrame:
    return _status(t.orders).select("total_orders", "returned_orders", "completed_orders")


@plan("q08_02_completion_and_return_rate")
def completion_and_return_rate(t: Tables) -> DataFrame:
    return _status(t.orders).select(*_status_percents())


@plan("q08_05_status_by_month")
def status_by_month(t: Tables) -> DataFrame:
    months = _status(t.orders, month_start(F.col("order_date")).alias("month_start"))
    return months.transform(sort_few, "month_start").select(
        year_month_name(F.col("month_start")).alias("month"),
        "total_orders",
        "completed_orders",
        "returned_orders",
        *_status_percents(),
    )
