"""Products and categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import labels
from tallyhouse.functions.numbers import money, money_per
from tallyhouse.functions.periods import month_of, month_start, year_month, year_of
from tallyhouse.operators import facts
from tallyhouse.operators.concentration import pareto_head
from tallyhouse.operators.growth import any_decline, period_growth
from tallyhouse.operators.ladder import with_dense_rank
from tallyhouse.operators.measures import average_order_size, return_rate, total_by
from tallyhouse.operators.ranking import sort_few, top_k_with_ties
from tallyhouse.operators.shares import contribution, price_or_volume
from tallyhouse.plans.registry import plan
from tallyhouse.plans.sales import monthly_revenue, yearly_revenue
from tallyhouse.sources.tables import Tables


def named(t: Tables, products: DataFrame) -> DataFrame:
    return products.join(t.products.select("product_id", "product_name"), "product_id")


def category_days(t: Tables) -> DataFrame:
    """Non-returned lines with category, date and cents."""
    return facts.order_line_fact(t, facts.NET, ("category", "order_date", "cents"))


@plan("q03_01_top_products_by_quantity")
def top_products_by_quantity(t: Tables, k: int = labels.TOP_K) -> DataFrame:
    sold = facts.product_quantities(t, facts.NET)
    return (
        named(t, top_k_with_ties(sold, "quantity", "quantity_rank", k))
        .select("product_id", "product_name", "quantity", "quantity_rank")
        .orderBy("quantity_rank", "product_id")
    )


@plan("q03_02a_top_products_by_revenue")
def top_products_by_revenue(t: Tables, k: int = labels.TOP_K) -> DataFrame:
    sold = facts.product_fact(t, facts.NET, "product_name")
    return (
        contribution(top_k_with_ties(sold, "cents", "revenue_rank", k), "cents", sold)
        .select(
            "product_id",
            "product_name",
            money(F.col("cents")).alias("revenue"),
            "share_percent",
            "revenue_rank",
        )
        .orderBy("revenue_rank", "product_id")
    )


def regional_products(t: Tables) -> DataFrame:
    """Region (a struct of its name), product, quantity and cents of non-returned orders.

    By name, as in the other regional reports; inside a struct a null name equals another.
    """
    located = facts.by_returns(t.orders, facts.NET).join(
        facts.customer_regions(t).select("customer_id", F.struct("region_name").alias("region")),
        "customer_id",
    )
    sold = (
        t.lines.join(located.select("order_id", "region"), "order_id")
        .groupBy("region", "product_id")
        .agg(F.sum(F.col("quantity").cast("long")).alias("quantity"))
    )
    return facts.with_product(t, sold, "product_name")


@plan("top_products_by_region")
def top_products_by_region(t: Tables, k: int = 3) -> DataFrame:
    """The products of the k highest revenues of each region, all ties included."""
    best = top_k_with_ties(regional_products(t), "cents", "region_rank", k, ("region",))
    return best.select(
        "region.region_name",
        "product_id",
        "product_name",
        money(F.col("cents")).alias("revenue"),
        "region_rank",
    ).orderBy("region_name", "region_rank", "product_id")


@plan("top_products_by_category")
def top_products_by_category(t: Tables, k: int = 3) -> DataFrame:
    """The products of the k highest revenues of each category, all ties included."""
    sold = facts.product_fact(t, facts.NET, "product_name", "category")
    return (
        top_k_with_ties(sold, "cents", "category_rank", k, ("category",))
        .select(
            "category",
            "product_id",
            "product_name",
            money(F.col("cents")).alias("revenue"),
            "category_rank",
        )
        .orderBy("category", "category_rank", "product_id")
    )


@plan("q03_02b_product_rank_by_region")
def product_rank_by_region(t: Tables) -> DataFrame:
    ranked = with_dense_rank(regional_products(t), "cents", "region_rank", ("region",))
    return (
        ranked.select(
            "region.region_name",
            "product_id",
            "product_name",
            money(F.col("cents")).alias("revenue"),
            "region_rank",
        )
        .orderBy("region_name", "region_rank", "product_id")
    )


@plan("q03_03_return_rate_by_product")
def return_rate_by_product(t: Tables) -> DataFrame:
    rates = return_rate(facts.order_product_fact(t), "product_id")
    return (
        named(t, rates)
        .select(
            "product_id", "product_name", "returned_orders", "total_orders", "return_rate_percent"
        )
        .orderBy(F.desc("return_rate_percent"), "product_id")
    )


@plan("q03_04_return_rate_by_category")
def return_rate_by_category(t: Tables) -> DataFrame:
    return return_rate(facts.order_categories(t), "category").transform(
        sort_few, F.desc("return_rate_percent")
    )


@plan("q03_05_average_price_by_region")
def average_price_by_region(t: Tables) -> DataFrame:
    sold = facts.regional(t, facts.order_fact(t, facts.NET), ("cents", "quantity"))
    return sold.select(
        "region_name", money_per(F.col("cents"), F.col("quantity")).alias("average_price")
    ).transform(sort_few, F.desc("average_price"))


@plan("q03_06a_category_growth_by_month")
def category_growth_by_month(t: Tables) -> DataFrame:
    months = monthly_revenue(category_days(t), "category")
    return period_growth(months, "cents", "month_start", ("category",)).select(
        "category",
        year_month(F.col("month_start")).alias("month"),
        money(F.col("cents")).alias("revenue"),
        "growth_percent",
    )


@plan("q03_06b_category_growth_by_year")
def category_growth_by_year(t: Tables) -> DataFrame:
    years = yearly_revenue(category_days(t), "category")
    return period_growth(years, "cents", "year", ("category",)).select(
        "category", "year", money(F.col("cents")).alias("revenue"), "growth_percent"
    )


@plan("q03_06c_category_growth_by_month_of_year")
def category_growth_by_month_of_year(t: Tables) -> DataFrame:
    day = F.col("month_start")
    months = (
        monthly_revenue(category_days(t), "category")
        .withColumn("year", year_of(day))
        .withColumn("month", month_of(day))
    )
    return (
        period_growth(months, "cents", "year", ("category", "month"))
        .select(
            "category",
            "year",
            "month",
            money(F.col("cents")).alias("revenue"),
            money(F.col("previous")).alias("previous_revenue"),
            "growth_percent",
        )
        .transform(sort_few, "category", "month", "year")
    )


@plan("q03_07_pareto_products")
def pareto_products(t: Tables, percent: int = labels.PARETO_PERCENT) -> DataFrame:
    head = pareto_head(facts.product_fact(t, facts.ALL, "product_name"), "cents", percent)
    return head.select(
        "product_id",
        "product_name",
        money(F.col("cents")).alias("revenue"),
        money(F.col("running")).alias("running_revenue"),
        money(F.col("grand_total")).alias("total_revenue"),
        "running_percent",
    ).orderBy(F.desc("revenue"), "product_id")


@plan("q03_08_declining_products")
def declining_products(t: Tables) -> DataFrame:
    months = facts.product_months(t, facts.NET)
    revenue = facts.with_product(t, months, "product_name")
    return any_decline(
        revenue, ("product_id", "product_name"), "month_start", "cents"
    ).orderBy("product_name", "product_id")


@plan("q03_09_order_quantity_by_product")
def order_quantity_by_product(t: Tables) -> DataFrame:
    sold = average_order_size(facts.order_product_fact(t, facts.NET), "product_id")
    return (
        named(t, sold)
        .select("product_id", "product_name", F.col("average_items").alias("average_quantity"))
        .orderBy(F.desc("average_quantity"), "product_id")
    )


@plan("q03_10_price_or_volume_driven")
def price_or_volume_driven(t: Tables) -> DataFrame:
    categories = total_by(
        facts.product_fact(t, facts.NET, "category"), ("category",), ("quantity", "cents")
    )
    return (
        price_or_volume(categories)
        .select(
            "category",
            "quantity",
            money(F.col("cents")).alias("revenue"),
            "quantity_percent",
            "revenue_percent",
            "category_type",
        )
        .orderBy(F.desc("revenue_percent"))
    )
