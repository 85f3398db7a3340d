"""Expected results: regions and returns by region."""

from __future__ import annotations

from tallyhouse.oracles.sql import big, each, growth, mean, money, pct, q

_REGIONS = (
    ", r AS (SELECT region_name, sum(cents) AS cents, count(*) AS orders,"
    " sum(quantity) AS quantity FROM kept_basket GROUP BY ALL)"
)
_CELLS = (
    ", x AS (SELECT region_name, category, sum(cents) AS cents, sum(quantity) AS quantity,"
    " count(DISTINCT order_id) AS orders FROM kept GROUP BY ALL)"
)
_SHARE = q(
    _REGIONS + f" SELECT region_name, {money('cents')} AS revenue,"
    f" {pct('cents', '(SELECT sum(cents) FROM r)')} AS share_percent FROM r ORDER BY 2 DESC"
)

SQL = {
    "q03_05_average_price_by_region": q(
        _REGIONS + f" SELECT region_name, {each('cents', 'quantity')} AS average_price"
        " FROM r ORDER BY 2 DESC"
    ),
    "q05_01_order_volume_by_region": q(
        ", v AS (SELECT region_name, count(*) AS orders"
        " FROM kept_purchase JOIN buyer USING (customer_id) GROUP BY ALL)"
        " SELECT region_name, orders, CASE orders WHEN (SELECT max(orders) FROM v) THEN 'Highest'"
        " WHEN (SELECT min(orders) FROM v) THEN 'Lowest' ELSE 'Middle' END AS volume_type"
        " FROM v ORDER BY 2 DESC"
    ),
    "q05_02_revenue_tier_by_region": q(
        _REGIONS + ", t AS (SELECT *, dense_rank() OVER (ORDER BY cents DESC) AS revenue_rank FROM r)"
        f" SELECT region_name, {money('cents')} AS revenue, revenue_rank,"
        " coalesce(list_extract(['Highest', 'High', 'High', 'Medium', 'Medium'], revenue_rank),"
        " 'Lower') AS revenue_type FROM t ORDER BY 3"
    ),
    "q05_03_order_value_by_region": q(
        _REGIONS + f" SELECT region_name, {each('cents', 'orders')} AS average_order_value"
        " FROM r ORDER BY 2 DESC"
    ),
    "q05_04_region_contribution": _SHARE,
    "q10_04_region_share_of_revenue": _SHARE,
    "q05_05a_category_sales_by_region": q(
        _CELLS + f" SELECT region_name, category, {money('cents')} AS revenue, orders,"
        f" {big('quantity')} AS quantity FROM x ORDER BY 3 DESC"
    ),
    "q05_05b_category_rank_by_region": q(
        _CELLS + f" SELECT region_name, category, {money('cents')} AS revenue, orders,"
        f" {big('quantity')} AS quantity,"
        " dense_rank() OVER (PARTITION BY region_name ORDER BY cents DESC) AS region_rank,"
        f" {pct('cents', 'sum(cents) OVER (PARTITION BY region_name)')} AS share_percent FROM x"
    ),
    "q06_02a_return_rate_by_region": q(
        " SELECT region_name, count(*) FILTER (is_returned) AS returned_orders,"
        " count(*) AS total_orders,"
        f" {pct('count(*) FILTER (is_returned)', 'count(*)')} AS return_rate_percent"
        " FROM purchase JOIN buyer USING (customer_id) GROUP BY 1 ORDER BY 4 DESC"
    ),
    "q06_04_revenue_lost": q(
        ", t AS (SELECT sum(cents) AS g, coalesce(sum(cents) FILTER (is_returned), 0) AS r FROM sale)"
        f" SELECT {money('g')} AS total_revenue, {money('r')} AS revenue_loss,"
        f" {money('g - r')} AS net_revenue, {pct('r', 'g')} AS loss_percent FROM t"
    ),
    "q10_01_active_customers_by_region": q(
        " SELECT region_name, count(DISTINCT customer_id) AS customers"
        " FROM purchase JOIN buyer USING (customer_id) GROUP BY 1 ORDER BY 2 DESC"
    ),
    "q10_02_spend_per_customer_by_region": q(
        f" SELECT region_name, {mean('sum(cents)', 'count(*)')} AS average_spend"
        " FROM spend JOIN buyer USING (customer_id) GROUP BY 1 ORDER BY 2 DESC"
    ),
    "q10_03_volume_against_revenue_by_region": q(
        _REGIONS + f" SELECT region_name, orders, {money('cents')} AS revenue,"
        f" {each('cents', 'orders')} AS average_order_value FROM r ORDER BY 2 DESC, 3"
    ),
    "q10_05_growth_by_region": q(
        ", g AS (SELECT region_name, m, sum(cents) AS cents FROM kept GROUP BY ALL)"
        ", s AS (SELECT *, lag(cents) OVER (PARTITION BY region_name ORDER BY m) AS before FROM g)"
        f" SELECT region_name, strftime(m, '%Y-%B') AS month, {money('cents')} AS revenue,"
        f" {growth('cents')} AS growth_percent FROM s ORDER BY region_name, m"
    ),
}
