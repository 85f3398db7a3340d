"""Reports that must agree with each other, on random shops."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tallyhouse.operators import facts
from tallyhouse.operators.measures import total_by
from tallyhouse.plans import (
    customers, efficiency, products, regions, returns, sales,
)


@pytest.fixture(params=[1, 2])
def random_shop(shop, request):
    draw = random.Random(request.param)
    day = date(2023, 1, 1)

    def when():
        return (day + timedelta(days=draw.randrange(700))).isoformat()

    return shop(
        regions=(1, 2, 3),
        customers=[(c, draw.randint(1, 3)) for c in range(30)],
        products=[
            (p, f"{draw.randint(100, 9999) / 100:.2f}", f"n{p % 7}", "ABC"[p % 3])
            for p in range(20)
        ],
        # customer 0 has a third of all orders
        orders=[
            (o, 0 if o % 3 == 0 else draw.randrange(30), when(), draw.random() < 0.3)
            for o in range(150)
        ],
        # product 0 has a third of all lines, order 1 another third
        lines=[
            (1 if k % 3 == 1 else draw.randrange(140), 0 if k % 3 == 0 else draw.randrange(20),
             draw.randint(1, 5))
            for k in range(500)
        ],
    )


def test_gap_by_first_and_last_equals_gap_by_neighbours(random_shop):
    t = random_shop
    earlier = Window.partitionBy("customer_id").orderBy("order_date", "order_id")
    gaps = (
        t.orders.withColumn(
            "days", F.datediff("order_date", F.lag("order_date").over(earlier)).cast("long")
        )
        .join(facts.customer_regions(t), "customer_id")
        .groupBy("region_name")
        .agg(F.round(F.sum("days") / F.count("days"), 2))
    )
    report = dict(rows(customers.gap_between_orders_by_region(t)))
    assert report == pytest.approx(dict(rows(gaps)), abs=0.0051)


def test_net_and_returned_make_gross(random_shop):
    gross, net, returned, _ = rows(sales.gross_and_net_revenue(random_shop))[0]
    assert gross == net + returned
    assert rows(sales.total_revenue(random_shop)) == [(gross,)]
    assert rows(sales.net_revenue(random_shop)) == [(net,)]


def test_same_results_under_two_names(random_shop):
    t = random_shop
    assert sorted(rows(regions.region_contribution_by_revenue(t))) == sorted(
        rows(regions.region_share_of_revenue(t))
    )
    assert sorted(rows(products.return_rate_by_category(t))) == sorted(
        rows(returns.return_rate_by_category(t))
    )


def test_top_customers_lead_the_lifetime_values(random_shop):
    top = rows(customers.top_customers(random_shop))
    values = rows(customers.customer_lifetime_value(random_shop))
    assert [r[2] for r in top] == [r[2] for r in values[:10]]
    assert set(top) <= set(values)
    assert {r[0] for r in top} <= {r[0] for r in rows(customers.top_customers_ranked(random_shop))}


def test_shares_add_up(random_shop):
    for report, column in (
        (sales.category_contribution, "share_percent"),
        (regions.region_contribution_by_revenue, "share_percent"),
        (customers.revenue_by_segment, "share_percent"),
        (efficiency.order_concentration, "share_percent"),
    ):
        shares = [r[column] for r in report(random_shop).collect()]
        assert abs(sum(shares) - 100) <= 0.005 * len(shares) + 1e-9


def test_rates_are_percentages(random_shop):
    for report in (products.return_rate_by_product, returns.return_rate_by_region_and_category):
        assert all(0 <= r["return_rate_percent"] <= 100 for r in report(random_shop).collect())


def test_sums_by_region_equal_sums_over_the_line_fact(random_shop):
    t = random_shop
    lines = facts.order_line_fact(t, facts.NET, ("region_name", "cents", "quantity"))
    plain = total_by(lines, ("region_name",), ("cents", "quantity"))
    summed = facts.regional(t, facts.order_fact(t, facts.NET), ("cents", "quantity"))
    assert sorted(rows(plain)) == sorted(rows(summed))


def test_distinct_orders_by_region_and_category(random_shop):
    t = random_shop
    lines = facts.order_line_fact(t, facts.NET, ("region_name", "category", "order_id"))
    plain = lines.groupBy("region_name", "category").agg(F.count_distinct("order_id"))
    report = regions.category_sales_by_region(t).select("region_name", "category", "orders")
    assert sorted(rows(plain)) == sorted(rows(report))
