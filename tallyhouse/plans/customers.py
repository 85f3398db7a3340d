"""Customers: top spenders, repeat behaviour, segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import labels
from tallyhouse.functions.numbers import money, money_per, percent2, ratio2
from tallyhouse.operators import facts, segments
from tallyhouse.operators.ladder import with_dense_rank
from tallyhouse.operators.measures import total_by
from tallyhouse.operators.ranking import sort_few, top_k_with_ties
from tallyhouse.operators.shares import contribution, contribution_of_few
from tallyhouse.plans.registry import plan
from tallyhouse.sources.tables import Tables

#: Bands that separate spends of some hundred thousand.
LARGE_SPENDS = (850_000, 600_000, 400_000)


def net_spend(t: Tables) -> DataFrame:
    """customer_id, cents, orders (with lines) over non-returned orders."""
    sold = facts.order_fact(t, facts.NET).where(F.col("customer_id").isNotNull())
    return segments.customer_value(sold)


def named(t: Tables, customers: DataFrame) -> DataFrame:
    return customers.join(t.customer_names, "customer_id")


@plan("q02_01a_top_customers")
def top_customers(t: Tables, k: int = labels.TOP_K) -> DataFrame:
    # the limit comes before the names, so only k rows meet the customer table
    best = net_spend(t).orderBy(F.desc("cents"), "customer_id").limit(k)
    return (
        named(t, best)
        .select("customer_id", "customer_name", money(F.col("cents")).alias("total_spent"))
        .orderBy(F.desc("total_spent"), "customer_id")
    )


@plan("q02_01b_top_customers_ranked")
def top_customers_ranked(t: Tables, k: int = labels.TOP_K) -> DataFrame:
    best = top_k_with_ties(net_spend(t), "cents", "spend_rank", k)
    return (
        named(t, best)
        .select(
            "customer_id", "customer_name", money(F.col("cents")).alias("total_spent"), "spend_rank"
        )
        .orderBy("spend_rank", "customer_id")
    )


@plan("q02_01c_top_customers_contribution")
def top_customers_contribution(t: Tables, k: int = labels.TOP_K) -> DataFrame:
    spend = net_spend(t)
    best = contribution(top_k_with_ties(spend, "cents", "spend_rank", k), "cents", spend)
    return (
        named(t, best)
        .select(
            "customer_id",
            "customer_name",
            money(F.col("cents")).alias("total_spent"),
            "share_percent",
            "spend_rank",
        )
        .orderBy("spend_rank", "customer_id")
    )


@plan("q02_02_repeat_customer_rate")
def repeat_customer_rate(t: Tables) -> DataFrame:
    customers = _orders_per_customer(t)
    repeated = F.sum(F.when(F.col("orders") > 1, 1).otherwise(0))
    return customers.agg(
        percent2(repeated, F.count("customer_id")).alias("repeat_customer_percent")
    )


@plan("q02_03_gap_between_orders_by_region")
def gap_between_orders_by_region(t: Tables) -> DataFrame:
    gaps = segments.inter_order_gap(t.orders)
    return (
        facts.regional(t, gaps, ("days", "gaps"))
        .select("region_name", ratio2(F.col("days"), F.col("gaps")).alias("average_days"))
        .transform(sort_few, "average_days")
    )


@plan("q02_04_customer_segments", limits=LARGE_SPENDS)
def customer_segments(
    t: Tables, limits: tuple[int, int, int] = labels.SPEND_LIMITS
) -> DataFrame:
    return named(t, net_spend(t)).select(
        "customer_name", segments.spend_segment(F.col("cents"), limits).alias("segment")
    )


@plan("q02_05_customer_lifetime_value")
def customer_lifetime_value(t: Tables) -> DataFrame:
    return (
        named(t, net_spend(t))
        .select("customer_id", "customer_name", money(F.col("cents")).alias("lifetime_value"))
        .orderBy(F.desc("lifetime_value"), "customer_id")
    )


def _segment_totals(t: Tables, limits: tuple[int, int, int]) -> DataFrame:
    """Cents and orders by segment; each customer's orders are already summed."""
    segment = segments.spend_segment(F.col("cents"), limits).alias("segment")
    return total_by(net_spend(t), (segment,), ("cents", "orders"))


@plan("q02_06_order_value_by_segment", limits=LARGE_SPENDS)
def order_value_by_segment(
    t: Tables, limits: tuple[int, int, int] = labels.SPEND_LIMITS
) -> DataFrame:
    return (
        _segment_totals(t, limits)
        .select(
            "segment", money_per(F.col("cents"), F.col("orders")).alias("average_order_value")
        )
        .transform(sort_few, F.desc("average_order_value"))
    )


@plan("q02_07_revenue_by_segment", limits=LARGE_SPENDS)
def revenue_by_segment(
    t: Tables, limits: tuple[int, int, int] = labels.SPEND_LIMITS
) -> DataFrame:
    return (
        contribution_of_few(_segment_totals(t, limits), "cents")
        .select("segment", money(F.col("cents")).alias("revenue"), "share_percent")
        .orderBy(F.desc("share_percent"))
    )


@plan("q02_08_new_and_repeat_revenue")
def new_and_repeat_revenue(t: Tables) -> DataFrame:
    kind = segments.new_or_repeat(F.col("orders")).alias("customer_type")
    bought = segments.customer_activity(t).where(F.col("cents").isNotNull())
    return contribution_of_few(total_by(bought, (kind,)), "cents").select(
        "customer_type", money(F.col("cents")).alias("revenue"), "share_percent"
    )


@plan("q02_09_order_frequency_rank")
def order_frequency_rank(t: Tables) -> DataFrame:
    return with_dense_rank(_orders_per_customer(t), "orders", "frequency_rank", counts=True).select(
        "customer_id", "orders", "frequency_rank"
    )


def _orders_per_customer(t: Tables) -> DataFrame:
    return total_by(facts.orders_of(t, facts.NET), ("customer_id",), ("orders",))
