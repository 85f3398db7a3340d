"""Edge rows of each report on small hand-made tables."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from conftest import rows
from tallyhouse.plans import PLANS
from tallyhouse.plans import (
    baskets, customers, efficiency, products, regions, returns, sales, trends,
)

D = Decimal


def one(frame):
    (row,) = rows(frame)
    return row


def test_segment_bands_and_their_gap(shop):
    spends = ["1500", "1500.01", "1000", "999.50", "999", "500", "499.99"]
    people = range(1, len(spends) + 1)
    t = shop(
        customers=[(i, 1) for i in people],
        products=[(i, s) for i, s in zip(people, spends)],
        orders=[(i, i) for i in people],
        lines=[(i, i, 1) for i in people],
    )
    expected = ["Gold", "Platinum", "Gold", "Bronze", "Silver", "Silver", "Bronze"]
    assert dict(rows(customers.customer_segments(t))) == {
        f"c{i}": label for i, label in zip(people, expected)
    }
    assert dict(rows(customers.order_value_by_segment(t))) == {
        "Platinum": 1500.01, "Gold": 1250.0, "Silver": 749.5, "Bronze": 749.75
    }
    shares = {r[0]: r[2] for r in rows(customers.revenue_by_segment(t))}
    assert abs(sum(shares.values()) - 100) < 0.03


def test_same_name_merges_by_name_only(shop):
    t = shop(
        products=[(1, "10", "mug"), (2, "20", "mug")],
        orders=[(1,)],
        lines=[(1, 1, 1), (1, 2, 1)],
    )
    assert rows(sales.revenue_by_product_name(t)) == [("mug", "A", D("30.00"))]
    assert len(rows(sales.top_product_contribution(t))) == 1
    assert [r[0] for r in rows(products.top_products_by_revenue(t))] == [2, 1]


def test_category_without_returns_is_shown(shop):
    t = shop(
        products=[(1, "10", "x", "A"), (2, "20", "y", "B")],
        orders=[(1, 1, "2024-01-01", True), (2,)],
        lines=[(1, 1, 1), (2, 1, 1), (2, 2, 1)],
    )
    expected = {("A", 1, 2, 50.0), ("B", 0, 1, 0.0)}
    assert set(rows(products.return_rate_by_category(t))) == expected
    assert set(rows(returns.return_rate_by_category(t))) == expected


def test_order_without_lines_counts_as_order_only(shop):
    t = shop(orders=[(1,), (2,)], lines=[(1, 1, 3)])
    assert rows(sales.mean_order_value(t)) == [(30.0,)]
    assert one(returns.orders_by_status(t)) == (2, 0, 2)
    assert rows(efficiency.orders_per_customer(t)) == [(2.0,)]
    assert rows(customers.repeat_customer_rate(t)) == [(100.0,)]
    # two orders, one with lines: a repeat customer
    assert rows(customers.new_and_repeat_revenue(t)) == [("Repeat Customer", D("30.00"), 100.0)]


def test_null_flag_is_in_totals_only(shop):
    t = shop(
        orders=[(1, 1, "2024-01-01", None), (2,), (3, 1, "2024-01-01", True)],
        lines=[(1, 1, 1), (2, 1, 2), (3, 1, 3)],
    )
    assert one(sales.net_revenue(t)) == (D("20.00"),)
    assert one(sales.gross_and_net_revenue(t)) == (D("60.00"), D("20.00"), D("30.00"), 50.0)
    assert one(returns.orders_by_status(t)) == (3, 1, 1)
    assert one(returns.revenue_lost(t)) == (D("60.00"), D("30.00"), D("30.00"), 50.0)


def test_growth_skips_a_month_without_orders(shop):
    t = shop(orders=[(1, 1, "2024-01-31"), (2, 1, "2024-03-01")], lines=[(1, 1, 2), (2, 1, 3)])
    assert rows(sales.growth_by_month(t)) == [
        ("2024-01", D("20.00"), None, None),
        ("2024-03", D("30.00"), D("20.00"), 50.0),
    ]
    assert [r[2] for r in rows(trends.order_volume_growth(t))] == [None, 0.0]
    assert [r[0] for r in rows(efficiency.order_frequency(t))] == ["2024-January", "2024-March"]


def test_same_month_of_the_last_present_year(shop):
    t = shop(orders=[(1, 1, "2020-05-01"), (2, 1, "2023-05-09")], lines=[(1, 1, 1), (2, 1, 4)])
    last = [r for r in rows(sales.growth_by_month_of_year(t)) if r[0] == 2023]
    assert last == [(2023, 5, "2023-05", D("40.00"), D("10.00"), 300.0)]
    last = [r for r in rows(products.category_growth_by_month_of_year(t)) if r[1] == 2023]
    assert last == [("A", 2023, 5, D("40.00"), D("10.00"), 300.0)]


def test_growth_from_nothing_is_null(shop):
    t = shop(
        products=[(1, "0.00"), (2, "5.00")],
        orders=[(1, 1, "2024-01-01"), (2, 1, "2024-02-01")],
        lines=[(1, 1, 1), (2, 2, 1)],
    )
    assert rows(sales.growth_by_month(t))[1] == ("2024-02", D("5.00"), D("0.00"), None)


def test_falling_revenue_is_negative(shop):
    t = shop(orders=[(1, 1, "2024-01-01"), (2, 1, "2024-02-01")], lines=[(1, 1, 3), (2, 1, 1)])
    assert rows(sales.growth_by_month(t))[1][3] == -66.67
    assert rows(products.declining_products(t)) == [(1, "p1")]


def test_steady_product_does_not_decline(shop):
    t = shop(orders=[(1, 1, "2024-01-01"), (2, 1, "2024-02-01")], lines=[(1, 1, 3), (2, 1, 3)])
    assert rows(products.declining_products(t)) == []


def test_two_orders_on_one_day(shop):
    t = shop(orders=[(1,), (2,)])
    assert one(efficiency.customer_lifecycle(t))[4:] == (0, "Same Day Repeat Buyer")
    assert rows(customers.gap_between_orders_by_region(t)) == [("r1", 0.0)]


@pytest.mark.parametrize(
    "day, label",
    [
        ("2023-01-30", "Short-term Buyer"),  # 29 days
        ("2023-01-31", "Mid-term Buyer"),    # 30
        ("2023-06-29", "Mid-term Buyer"),    # 179
        ("2023-06-30", "Long-term Buyer"),   # 180
    ],
)
def test_lifecycle_limits(shop, day, label):
    t = shop(orders=[(1, 1, "2023-01-01"), (2, 1, day)])
    assert one(efficiency.customer_lifecycle(t))[5] == label


def test_only_order_returned(shop):
    t = shop(
        customers=[(1, 1), (2, 1)],
        orders=[(1, 1, "2024-01-01", True), (2, 2), (3, 2)],
        lines=[(1, 1, 1), (2, 1, 1)],
    )
    assert one(efficiency.inactive_customers(t)) == (1, 0, 1, 0.0, 100.0)
    assert [r[0] for r in rows(customers.new_and_repeat_revenue(t))] == ["Repeat Customer"]
    assert set(rows(returns.return_rate_of_new_and_repeat(t))) == {
        ("New Customer", 1, 1, 100.0), ("Repeat Customer", 0, 2, 0.0)
    }


def test_tie_at_rank_ten_gives_eleven_rows(shop):
    numbers = range(1, 12)
    t = shop(
        products=[(i, "1.00") for i in numbers],
        orders=[(1,)],
        lines=[(1, i, 100 - min(i, 10)) for i in numbers],
    )
    assert len(rows(products.top_products_by_quantity(t))) == 11
    assert len(rows(products.top_products_by_revenue(t))) == 11
    assert one(efficiency.top_products_share(t))[2] == 100.0


def test_equal_regions_are_all_highest(shop):
    t = shop(regions=(1, 2), customers=[(1, 1), (2, 2)], orders=[(1, 1), (2, 2)])
    assert {r[2] for r in rows(regions.order_volume_by_region(t))} == {"Highest"}


def test_basket_bins(shop):
    sizes = [1, 2, 3, 4, 5, 6, 10, 11]
    t = shop(
        orders=[(i,) for i, _ in enumerate(sizes)], lines=[(i, 1, n) for i, n in enumerate(sizes)]
    )
    counts = {r[0]: r[1] for r in rows(baskets.order_value_by_basket_size(t))}
    assert counts == {
        "1 Item": 1, "2-3 Items": 2, "4-5 Items": 2, "6-10 Items": 2, "10+ Items": 1
    }
    assert dict(rows(baskets.single_and_multi_item_revenue(t))) == {
        "Single-item Order": D("10.00"), "Multi-item Order": D("410.00")
    }


def test_basket_equal_to_both_means(shop):
    t = shop(orders=[(1,), (2,)], lines=[(1, 1, 2), (2, 1, 2)])
    assert {r[3] for r in rows(baskets.basket_types(t))} == {"High Quantity & High Value"}


def test_basket_types(shop):
    t = shop(
        products=[(1, "1.00"), (2, "100.00")],
        orders=[(1,), (2,), (3,)],
        lines=[(1, 1, 9), (2, 2, 1), (3, 1, 1)],
    )
    assert {r[0]: r[3] for r in rows(baskets.basket_types(t))} == {
        1: "High Quantity Basket", 2: "High Value Basket", 3: "Normal Basket"
    }


def test_one_category_on_two_lines_is_no_combination(shop):
    t = shop(
        products=[(1, "1", "x", "A"), (2, "1", "y", "B"), (3, "1", "z", "A")],
        orders=[(1,), (2,), (3,)],
        lines=[(1, 1, 1), (1, 3, 1), (2, 2, 1), (2, 1, 1), (3, 1, 1), (3, 2, 1), (3, 3, 1)],
    )
    assert rows(baskets.combinations_of_categories(t)) == [("A, B", 2)]


def test_weekend_is_saturday_and_sunday(shop):
    days = ["2024-03-01", "2024-03-02", "2024-03-03", "2024-03-04"]  # Friday to Monday
    t = shop(
        orders=[(i, 1, d) for i, d in enumerate(days)], lines=[(i, 1, 1) for i, _ in enumerate(days)]
    )
    assert {r[0]: r[2] for r in rows(trends.weekday_and_weekend(t))} == {"Weekend": 2, "Weekday": 2}


def test_last_year_starts_twelve_months_before(shop):
    days = ["2023-03-15", "2023-03-14", "2024-03-15"]
    t = shop(
        orders=[(i, 1, d) for i, d in enumerate(days)], lines=[(i, 1, 1) for i, _ in enumerate(days)]
    )
    expected = [(2023, 3, D("10.00")), (2024, 3, D("10.00"))]
    assert rows(trends.last_year_by_month(t)) == expected
    assert rows(trends.last_year_by_month(t, date(2024, 3, 15))) == expected
    assert rows(trends.last_year_by_month(t, date(2024, 3, 16))) == expected[1:]


def test_revenue_above_eight_digits(shop):
    t = shop(products=[(1, "99999999.99")], orders=[(1,)], lines=[(1, 1, 500)])
    assert rows(trends.order_value_by_month(t)) == [("2024-01", 49999999995.0)]
    assert one(products.price_or_volume_driven(t))[2] == D("49999999995.00")
    assert one(trends.weekday_and_weekend(t))[1] == D("49999999995.00")


def test_unpriced_product_adds_nothing_and_is_kept(shop):
    t = shop(
        products=[(1, None), (2, "10.00")],
        orders=[(1,)],
        lines=[(1, 1, 5), (1, 2, 1)],
    )
    assert one(sales.total_revenue(t)) == (D("10.00"),)
    assert one(efficiency.top_products_share(t))[2] == 100.0


def test_new_customer_by_all_orders_or_by_kept_orders(shop):
    t = shop(orders=[(1,), (2, 1, "2024-01-02", True)], lines=[(1, 1, 1), (2, 1, 1)])
    assert rows(customers.new_and_repeat_revenue(t))[0][0] == "New Customer"
    assert rows(returns.return_rate_of_new_and_repeat(t))[0][0] == "Repeat Customer"


def test_highly_active_share(shop):
    t = shop(
        customers=[(1, 1), (2, 1)],
        orders=[(i, 1) for i in range(5)] + [(9, 2)],
        lines=[(0, 1, 3), (9, 1, 1)],
    )
    assert one(efficiency.highly_active_customers(t)) == (D("40.00"), D("30.00"), 75.0)
    assert one(efficiency.highly_active_customers(t, 6)) == (D("40.00"), D("0.00"), 0.0)


def test_frequent_returners(shop):
    t = shop(orders=[(i, 1, "2024-01-01", i < 4) for i in range(6)])
    assert rows(returns.frequent_returners(t)) == [(1, "c1", 4, 6, 66.67)]
    assert rows(returns.frequent_returners(t, 5)) == []


@pytest.mark.parametrize("name", sorted(PLANS))
def test_empty_tables_are_no_error(shop, name):
    assert PLANS[name](shop(products=(), customers=(), regions=())).collect() is not None
