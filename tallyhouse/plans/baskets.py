"""Basket contents and sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import labels
from tallyhouse.functions.numbers import money, ratio2
from tallyhouse.operators import facts
from tallyhouse.operators.basket import basket_type, category_combinations
from tallyhouse.operators.measures import average_order_value, total_by
from tallyhouse.operators.ranking import sort_few
from tallyhouse.operators.segments import classify
from tallyhouse.plans.registry import plan
from tallyhouse.sources.tables import Tables

#: Bins for orders of up to some hundred items.
LARGE_BINS = (("1 Item", 1, 1), ("2-50 Items", 2, 50), ("51-100 Items", 51, 100),
              ("101-150 Items", 101, 150))


@plan("q09_01_items_per_order")
def items_per_order(t: Tables) -> DataFrame:
    sizes = facts.order_quantities(t)
    return sizes.agg(
        ratio2(F.sum("quantity"), F.count("quantity")).alias("average_items")
    )


@plan("q09_02_category_combinations")
def combinations_of_categories(t: Tables) -> DataFrame:
    lines = t.lines.join(t.products.select("product_id", "category"), "product_id")
    return category_combinations(lines, "order_id", "category").orderBy(F.desc("orders"))


@plan(
    "q09_03_single_and_multi_item_revenue",
    single=50,
    few="Order of 1 to 50 items",
    many="Other order",
)
def single_and_multi_item_revenue(
    t: Tables, single: int = 1, few: str = labels.SINGLE_ITEM, many: str = labels.MULTI_ITEM
) -> DataFrame:
    """Orders of 1 to ``single`` items against the others."""
    kind = F.when(F.col("quantity").between(1, single), few).otherwise(many)
    return total_by(facts.order_fact(t, facts.NET), (kind.alias("order_type"),)).select(
        "order_type", money(F.col("cents")).alias("revenue")
    )


@plan("q09_04_basket_types")
def basket_types(t: Tables) -> DataFrame:
    return (
        basket_type(facts.order_fact(t, facts.NET).select("order_id", "quantity", "cents"))
        .orderBy(F.desc("cents"), "order_id")
        .select(
            "order_id",
            "quantity",
            money(F.col("cents")).alias("order_value"),
            "basket_type",
        )
    )


@plan("q09_05_order_value_by_basket_size", bins=LARGE_BINS, largest="150+ Items")
def order_value_by_basket_size(
    t: Tables, bins=labels.BASKET_BINS, largest: str = labels.LARGEST_BASKET
) -> DataFrame:
    orders = facts.order_fact(t, facts.NET).withColumn(
        "basket_size", classify(F.col("quantity"), bins, largest)
    )
    return (
        average_order_value(orders, "basket_size")
        .select(
            "basket_size",
            "orders",
            "average_order_value",
            money(F.col("cents")).alias("revenue"),
        )
        .transform(sort_few, F.desc("revenue"))
    )
