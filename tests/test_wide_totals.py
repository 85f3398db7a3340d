"""Totals beyond 64 bits, unpriced products, names shared by regions, and column order of files."""

from __future__ import annotations

from decimal import Decimal

import pytest

from conftest import rows
from tallyhouse.plans import PLANS, baskets, efficiency, products, sales
from tallyhouse.sources.tables import from_frames

MONEY = sorted(
    name
    for name in PLANS
    if not name.startswith(("check_", "window_", "fact_", "q08", "q09_01", "q09_02", "q12_01", "q12_02", "q12_03"))
)
PRICE = Decimal("99999999.99")


def large_shop(shop, one_product: bool):
    orders = [
        (k, 1 + k % 40, f"20{20 + k % 4}-{1 + k % 12:02d}-10", k % 5 == 0) for k in range(1, 121)
    ]
    # 12e6 items at 99,999,999.99 are 1.2e17 cents an order, 1.4e19 in all
    lines = [(k, 1 if one_product else 1 + k % 6, 12_000_000) for k in range(1, 121)]
    return shop(
        orders=orders,
        lines=lines,
        products=[(p, PRICE, f"p{p}", f"c{p % 3}") for p in range(1, 7)],
        customers=[(c, 1 + c % 3) for c in range(1, 41)],
        regions=(1, 2, 3),
    )


@pytest.mark.parametrize("name", MONEY)
def test_totals_beyond_64_bits(shop, name):
    assert PLANS[name](large_shop(shop, one_product=False)).collect() is not None


@pytest.mark.parametrize("name", MONEY)
def test_one_product_beyond_64_bits_in_every_report(shop, name):
    assert PLANS[name](large_shop(shop, one_product=True)).collect() is not None


def test_ranks_and_running_sums_of_one_product_beyond_64_bits(shop):
    orders = [(k, 1, "2024-01-01", False) for k in range(1, 61)]
    lines = [(k, 1, 2_000_000_000) for k in range(1, 61)] + [(1, 2, 5), (2, 3, -5), (3, 4, 1), (4, 5, 0)]
    priced = [(1, PRICE), (2, "10.00"), (3, "10.00"), (4, None), (5, "1.00")]
    t = shop(orders=orders, lines=lines, products=[(p, price, f"p{p}") for p, price in priced])
    most = PRICE * 2_000_000_000 * 60
    assert int(most * 100) > 2**63
    # null comes last, below the negative revenue
    assert [(r[1], r[3], r[4]) for r in products.product_rank_by_region(t).collect()] == [
        (1, most, 1), (2, Decimal("50.00"), 2), (5, Decimal("0.00"), 3), (3, Decimal("-50.00"), 4), (4, None, 5),
    ]
    assert [(r[0], r[2], r[4]) for r in products.top_products_by_revenue(t).collect()] == [
        (1, most, 1), (2, Decimal("50.00"), 2), (5, Decimal("0.00"), 3), (3, Decimal("-50.00"), 4), (4, None, 5),
    ]
    assert rows(products.pareto_products(t)) == []
    assert [r[0] for r in products.pareto_products(t, percent=100).collect()] == [1, 3, 4]
    assert rows(efficiency.long_tail_of_products(t))[0][0] == 100.0


def test_one_product_beyond_64_bits(shop):
    t = large_shop(shop, one_product=True)
    total = PRICE * 12_000_000 * 120
    assert int(total * 100) > 2**63
    assert rows(PLANS["q01_01_total_revenue"](t))[0][0] == total
    assert rows(products.top_products_by_revenue(t))[0][2] == total * 96 / 120
    assert rows(sales.top_product_contribution(t))[0][1] == total


def test_unpriced_product_is_ranked_last_and_stays_null(shop):
    t = shop(
        orders=[(1,), (2,)],
        lines=[(1, 1, 1), (1, 2, 1), (2, 3, 1)],
        products=[(1, None), (2, "10.00"), (3, "0.00")],
    )
    assert [tuple(r)[0:3] + (r[4],) for r in products.top_products_by_revenue(t).collect()] == [
        (2, "p2", Decimal("10.00"), 1),
        (3, "p3", Decimal("0.00"), 2),
        (1, "p1", None, 3),
    ]
    assert [(r[1], r[3], r[4]) for r in products.product_rank_by_region(t).collect()] == [
        (2, Decimal("10.00"), 1),
        (3, Decimal("0.00"), 2),
        (1, None, 3),
    ]


def test_regions_of_one_name_are_one_group(shop, spark):
    t = shop(
        orders=[(1, 1), (2, 2)],
        lines=[(1, 1, 1), (2, 1, 2)],
        customers=[(1, 1), (2, 2)],
        regions=(1, 2),
    )
    same = t.regions.withColumn("region_name", t.regions["region_name"].substr(1, 1))
    t = from_frames(regions=same, **{n: getattr(t, n) for n in ("customers", "products", "orders", "lines")})
    assert [(r[0], r[1], r[3], r[4]) for r in products.product_rank_by_region(t).collect()] == [
        ("r", 1, Decimal("30.00"), 1)
    ]


def test_combinations_of_one_text_are_one_row(shop):
    t = shop(
        orders=[(1,), (2,)],
        lines=[(1, 1, 1), (1, 2, 1), (2, 3, 1), (2, 4, 1)],
        products=[(1, "1.00", "a", "A, B"), (2, "1.00", "b", "C"), (3, "1.00", "c", "A"), (4, "1.00", "d", "B, C")],
    )
    assert rows(baskets.combinations_of_categories(t)) == [("A, B, C", 2)]


def test_orders_without_items_are_not_small_orders(shop):
    t = shop(orders=[(1,), (2,)], lines=[(1, 1, 0), (2, 1, 1)])
    for single in (1, 50):
        found = dict(rows(baskets.single_and_multi_item_revenue(t, single, "few", "many")))
        assert found == {"many": Decimal("0.00"), "few": Decimal("10.00")}
