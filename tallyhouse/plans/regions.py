"""Regions and market penetration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import labels
from tallyhouse.functions.numbers import mean_money, money, money_per, total
from tallyhouse.functions.periods import month_start, year_month_name
from tallyhouse.operators import facts
from tallyhouse.operators.growth import period_growth
from tallyhouse.operators.measures import average_order_value
from tallyhouse.operators.ranking import rank_few, sort_few, tier, with_extremes
from tallyhouse.operators.segments import customer_value
from tallyhouse.operators.shares import contribution_of_few
from tallyhouse.plans.registry import plan
from tallyhouse.sources.tables import Tables


def regional_sales(t: Tables, *keys: str) -> DataFrame:
    """region_name, keys, cents, orders over non-returned orders with lines."""
    return facts.regional(t, facts.order_fact(t, facts.NET), ("cents", "orders"), keys)


def regional_categories(t: Tables) -> DataFrame:
    """region_name, category, cents, orders, quantity over non-returned orders."""
    return facts.regional(
        t,
        facts.order_category_fact(t, facts.NET),
        ("cents", "orders", "quantity"),
        ("category",),
    )


@plan("q05_01_order_volume_by_region")
def order_volume_by_region(t: Tables) -> DataFrame:
    volumes = facts.regional(t, facts.orders_of(t, facts.NET), ("orders",))
    kind = (
        F.when(F.col("is_highest"), labels.VOLUME_HIGHEST)
        .when(F.col("is_lowest"), labels.VOLUME_LOWEST)
        .otherwise(labels.VOLUME_MIDDLE)
    )
    return (
        with_extremes(volumes, "orders")
        .select("region_name", "orders", kind.alias("volume_type"))
        .orderBy(F.desc("orders"))
    )


@plan("q05_02_revenue_tier_by_region")
def revenue_tier_by_region(t: Tables) -> DataFrame:
    kind = tier(F.col("revenue_rank"), labels.REVENUE_TIERS, labels.LOWEST_TIER)
    return (
        rank_few(regional_sales(t), "cents", "revenue_rank")
        .select(
            "region_name",
            money(F.col("cents")).alias("revenue"),
            "revenue_rank",
            kind.alias("revenue_type"),
        )
        .orderBy(F.desc("revenue"))
    )


@plan("q05_03_order_value_by_region")
def order_value_by_region(t: Tables) -> DataFrame:
    return (
        average_order_value(regional_sales(t), "region_name")
        .select("region_name", "average_order_value")
        .transform(sort_few, F.desc("average_order_value"))
    )


def region_contribution(t: Tables) -> DataFrame:
    return contribution_of_few(regional_sales(t), "cents").select(
        "region_name", money(F.col("cents")).alias("revenue"), "share_percent"
    )


@plan("q05_04_region_contribution")
def region_contribution_by_revenue(t: Tables) -> DataFrame:
    return region_contribution(t).orderBy(F.desc("revenue"))


@plan("q05_05a_category_sales_by_region")
def category_sales_by_region(t: Tables) -> DataFrame:
    return (
        regional_categories(t)
        .select(
            "region_name",
            "category",
            money(F.col("cents")).alias("revenue"),
            "orders",
            "quantity",
        )
        .transform(sort_few, F.desc("revenue"))
    )


@plan("q05_05b_category_rank_by_region")
def category_rank_by_region(t: Tables) -> DataFrame:
    shared = contribution_of_few(regional_categories(t), "cents", ("region_name",))
    return (
        rank_few(shared, "cents", "region_rank", ("region_name",))
        .select(
            "region_name",
            "category",
            money(F.col("cents")).alias("revenue"),
            "orders",
            "quantity",
            "region_rank",
            "share_percent",
        )
        .transform(sort_few, "region_name", "region_rank")
    )


@plan("q10_01_active_customers_by_region")
def active_customers_by_region(t: Tables) -> DataFrame:
    active = t.orders.select("customer_id").distinct()
    return (
        active.join(facts.customer_regions(t), "customer_id")
        .groupBy("region_name")
        .agg(F.count("customer_id").alias("customers"))
        .transform(sort_few, F.desc("customers"))
    )


@plan("q10_02_spend_per_customer_by_region")
def spend_per_customer_by_region(t: Tables) -> DataFrame:
    spend = customer_value(facts.order_fact(t, facts.NET))
    return (
        spend.join(facts.customer_regions(t), "customer_id")
        .groupBy("region_name")
        .agg(total(F.col("cents")).alias("cents"), F.count("cents").alias("customers"))
        .select(
            "region_name",
            mean_money(F.col("cents"), F.col("customers")).alias("average_spend"),
        )
        .transform(sort_few, F.desc("average_spend"))
    )


@plan("q10_03_volume_against_revenue_by_region")
def volume_against_revenue_by_region(t: Tables) -> DataFrame:
    cents, orders = F.col("cents"), F.col("orders")
    return (
        regional_sales(t)
        .select(
            "region_name",
            "orders",
            money(cents).alias("revenue"),
            money_per(cents, orders).alias("average_order_value"),
        )
        .transform(sort_few, F.desc("orders"), "revenue")
    )


@plan("q10_04_region_share_of_revenue")
def region_share_of_revenue(t: Tables) -> DataFrame:
    return region_contribution(t).orderBy(F.desc("share_percent"))


@plan("q10_05_growth_by_region")
def growth_by_region(t: Tables) -> DataFrame:
    orders = facts.order_fact(t, facts.NET).withColumn(
        "month_start", month_start(F.col("order_date"))
    )
    months = facts.regional(t, orders, ("cents",), ("month_start",))
    return (
        period_growth(months, "cents", "month_start", ("region_name",))
        .transform(sort_few, "region_name", "month_start")
        .select(
            "region_name",
            year_month_name(F.col("month_start")).alias("month"),
            money(F.col("cents")).alias("revenue"),
            "growth_percent",
        )
    )
