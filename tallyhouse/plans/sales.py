"""General sales: revenue, order values, growth and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import WHOLE, mean_money, money, total
from tallyhouse.functions.periods import month_of, month_start, year_month, year_of
from tallyhouse.operators import facts
from tallyhouse.operators.growth import period_growth
from tallyhouse.operators.measures import (
    average_order_value, gross_net_returned, revenue_by, total_by,
)
from tallyhouse.operators.places import with_places
from tallyhouse.operators.ranking import rank_few, sort_few, top_k_with_ties, with_extremes
from tallyhouse.operators.shares import contribution, contribution_of_few, total_of
from tallyhouse.plans.registry import plan
from tallyhouse.sources.tables import Tables


def monthly_revenue(orders: DataFrame, *keys: str) -> DataFrame:
    """month (first day), keys, cents."""
    return total_by(orders, (month_start(F.col("order_date")).alias("month_start"), *keys))


def yearly_revenue(orders: DataFrame, *keys: str) -> DataFrame:
    """year, keys, cents."""
    return total_by(orders, (year_of(F.col("order_date")).alias("year"), *keys))


def growth_columns():
    return (
        money(F.col("cents")).alias("revenue"),
        money(F.col("previous")).alias("previous_revenue"),
        "growth_percent",
    )


@plan("q01_01_total_revenue")
def total_revenue(t: Tables) -> DataFrame:
    return revenue_by(facts.product_fact(t))


@plan("q01_02_net_revenue")
def net_revenue(t: Tables) -> DataFrame:
    return revenue_by(facts.product_fact(t, facts.NET))


@plan("q01_03_revenue_by_month")
def revenue_by_month(t: Tables) -> DataFrame:
    month = F.col("month_start")
    return (
        monthly_revenue(facts.order_fact(t))
        .transform(sort_few, F.desc("month_start"))
        .select(
            year_of(month).alias("year"),
            month_of(month).alias("month"),
            money(F.col("cents")).alias("revenue"),
        )
    )


@plan("q01_04a_revenue_by_product_name")
def revenue_by_product_name(t: Tables) -> DataFrame:
    products = facts.product_fact(t, facts.ALL, "product_name", "category")
    return revenue_by(products, "product_name", "category").orderBy(
        "category", F.desc("revenue"), "product_name"
    )


@plan("q01_04b_revenue_by_category")
def revenue_by_category(t: Tables) -> DataFrame:
    categories = facts.product_fact(t, facts.ALL, "category")
    return revenue_by(categories, "category").transform(sort_few, F.desc("revenue"))


@plan("q01_05_average_order_value")
def mean_order_value(t: Tables) -> DataFrame:
    totals = facts.order_values(t).agg(
        total(F.col("cents")).alias("cents"), F.count("cents").alias("orders")
    )
    return totals.select(
        mean_money(F.col("cents"), F.col("orders")).alias("average_order_value")
    )


@plan("q01_06_average_order_value_by_month")
def average_order_value_by_month(t: Tables) -> DataFrame:
    month = F.col("month_start")
    orders = facts.order_fact(t).withColumn("month_start", month_start(F.col("order_date")))
    return (
        average_order_value(orders, "month_start", rounded=False)
        .transform(sort_few, F.desc("month_start"))
        .select(
            year_of(month).alias("year"), month_of(month).alias("month"), "average_order_value"
        )
    )


@plan("q01_07_average_order_size_by_region")
def average_order_size_by_region(t: Tables) -> DataFrame:
    orders = facts.order_quantities(t).join(facts.orders_of(t), "order_id")
    size = F.col("quantity").cast("double") / F.col("orders").cast("double")
    return (
        facts.regional(t, orders, ("quantity", "orders"))
        .select("region_name", size.alias("average_items"))
        .transform(sort_few, F.desc("average_items"))
    )


@plan("q01_08_gross_net_returned")
def gross_and_net_revenue(t: Tables) -> DataFrame:
    return gross_net_returned(facts.order_fact(t)).select(
        money(F.col("gross")).alias("gross_revenue"),
        money(F.col("net")).alias("net_revenue"),
        money(F.col("returned")).alias("returned_revenue"),
        "returned_percent",
    )


@plan("q01_09a_growth_by_month")
def growth_by_month(t: Tables) -> DataFrame:
    months = monthly_revenue(facts.order_fact(t))
    return (
        period_growth(months, "cents", "month_start")
        .orderBy("month_start")
        .select(year_month(F.col("month_start")).alias("month"), *growth_columns())
    )


@plan("q01_09b_growth_by_year")
def growth_by_year(t: Tables) -> DataFrame:
    years = yearly_revenue(facts.order_fact(t))
    return (
        period_growth(years, "cents", "year").orderBy("year").select("year", *growth_columns())
    )


@plan("q01_09c_growth_by_month_of_year")
def growth_by_month_of_year(t: Tables) -> DataFrame:
    day = F.col("month_start")
    months = (
        monthly_revenue(facts.order_fact(t))
        .withColumn("year", year_of(day))
        .withColumn("month", month_of(day))
    )
    return period_growth(months, "cents", "year", ("month",)).select(
        "year", "month", year_month(day).alias("year_month"), *growth_columns()
    )


@plan("q01_10_extreme_months")
def extreme_months(t: Tables) -> DataFrame:
    months = with_extremes(monthly_revenue(facts.order_fact(t)), "cents")
    return months.where(F.col("is_highest") | F.col("is_lowest")).select(
        year_month(F.col("month_start")).alias("year_month"),
        money(F.col("cents")).alias("revenue"),
    )


@plan("q01_11a_category_contribution")
def category_contribution(t: Tables) -> DataFrame:
    categories = total_by(facts.product_fact(t, facts.ALL, "category"), ("category",))
    shared = contribution_of_few(categories, "cents")
    return (
        rank_few(shared, "cents", "revenue_rank")
        .select("category", money(F.col("cents")).alias("revenue"), "share_percent", "revenue_rank")
        .orderBy("revenue_rank")
    )


@plan("q01_11b_top_product_contribution")
def top_product_contribution(t: Tables, k: int = 10) -> DataFrame:
    names = total_by(facts.product_fact(t, facts.ALL, "product_name"), ("product_name",))
    top = top_k_with_ties(names, "cents", "revenue_rank", k)
    # at most k rows: what the values above each of the k highest add up to
    earlier = Window.orderBy("revenue_rank").rowsBetween(Window.unboundedPreceding, -1)
    above = (
        top.groupBy("revenue_rank")
        .agg(total(F.col("cents")).alias("_sum"))
        .select("revenue_rank", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_above"))
    )
    # row by row, in name order among ties
    placed = with_places(top, "revenue_rank", "product_name", "_place")
    so_far = F.col("_above") + F.coalesce("cents", F.lit(0)) * F.col("_place").cast("decimal(19,0)")
    running = so_far.cast(WHOLE).cast("double")
    return (
        contribution(placed.join(F.broadcast(above), "revenue_rank"), "cents", names)
        .withColumn("_total", total_of(names, "cents").cast("double"))
        .select(
            "product_name",
            money(F.col("cents")).alias("revenue"),
            "share_percent",
            (running / F.col("_total") * 100).alias("running_percent"),
            "revenue_rank",
        )
        .orderBy("revenue_rank", "product_name")
    )
