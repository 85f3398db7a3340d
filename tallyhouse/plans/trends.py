"""Time: trends of the last year, order volume, seasons, weekdays."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import money
from tallyhouse.functions.periods import month_of, month_start, year_month, year_of
from tallyhouse.operators import facts
from tallyhouse.operators.growth import period_growth
from tallyhouse.operators.measures import average_order_value, total_by
from tallyhouse.operators.ranking import sort_few
from tallyhouse.operators.seasons import season_type, weekday_weekend
from tallyhouse.plans.registry import plan
from tallyhouse.plans.sales import growth_columns, monthly_revenue
from tallyhouse.sources.tables import Tables


def last_year(t: Tables, as_of: date | None) -> DataFrame:
    """Non-returned lines dated from 12 months before as_of (default: the latest order).

    The date cuts the orders before they meet the lines, and so the lines before
    they meet the products. A layout by month reads the months since then only.
    """
    end = t.orders.agg(F.max("order_date")).scalar() if as_of is None else F.lit(as_of)
    start = F.add_months(end, -12)
    recent = facts.order_line_fact(t.since(start), facts.NET, ("order_date", "cents"))
    return recent.where(F.col("order_date") >= start)


@plan("q04_01a_last_year_by_month")
def last_year_by_month(t: Tables, as_of: date | None = None) -> DataFrame:
    month = F.col("month_start")
    return (
        monthly_revenue(last_year(t, as_of))
        .transform(sort_few, "month_start")
        .select(
            year_of(month).alias("year"),
            month_of(month).alias("month"),
            money(F.col("cents")).alias("revenue"),
        )
    )


@plan("q04_01b_last_year_growth")
def last_year_growth(t: Tables, as_of: date | None = None) -> DataFrame:
    months = monthly_revenue(last_year(t, as_of))
    return (
        period_growth(months, "cents", "month_start")
        .orderBy("month_start")
        .select(year_month(F.col("month_start")).alias("month"), *growth_columns())
    )


@plan("q04_02_order_value_by_month")
def order_value_by_month(t: Tables) -> DataFrame:
    orders = facts.order_fact(t, facts.NET).withColumn(
        "month_start", month_start(F.col("order_date"))
    )
    return (
        average_order_value(orders, "month_start")
        .transform(sort_few, "month_start")
        .select(year_month(F.col("month_start")).alias("month"), "average_order_value")
    )


def monthly_orders(t: Tables) -> DataFrame:
    """month_start, orders, previous, growth_percent of non-returned orders."""
    months = total_by(
        facts.orders_of(t, facts.NET),
        (month_start(F.col("order_date")).alias("month_start"),),
        ("orders",),
    )
    return period_growth(months, "orders", "month_start").orderBy("month_start")


@plan("q04_03_order_volume_growth")
def order_volume_growth(t: Tables) -> DataFrame:
    return monthly_orders(t).select(
        year_month(F.col("month_start")).alias("month"), "orders", "growth_percent"
    )


@plan("q04_04_seasons")
def seasons(t: Tables) -> DataFrame:
    orders = facts.order_fact(t, facts.NET)
    months = total_by(orders, (month_of(F.col("order_date")).alias("month"),))
    name = F.date_format(F.make_date(F.lit(2000), F.col("month").cast("int"), F.lit(1)), "MMMM")
    return (
        season_type(months, "cents", "month")
        .select(
            "month",
            name.alias("month_name"),
            money(F.col("cents")).alias("revenue"),
            "season_type",
        )
        .orderBy(F.desc("revenue"))
    )


@plan("q04_05_weekday_and_weekend")
def weekday_and_weekend(t: Tables) -> DataFrame:
    return (
        weekday_weekend(facts.order_fact(t, facts.NET))
        .select(
            "day_type",
            money(F.col("cents")).alias("revenue"),
            "orders",
            "average_order_value",
        )
        .transform(sort_few, F.desc("revenue"))
    )
