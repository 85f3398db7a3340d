"""Expected results: customers, their activity and concentration."""

from __future__ import annotations

from tallyhouse.oracles.sql import each, money, pct, q, ratio


def _segment(platinum: int, gold: int, silver: int) -> str:
    spend = "cents / 100.0"
    return (
        f"CASE WHEN {spend} > {platinum} THEN 'Platinum' WHEN {spend} >= {gold} THEN 'Gold'"
        f" WHEN {spend} >= {silver} AND {spend} <= {gold} - 1 THEN 'Silver' ELSE 'Bronze' END"
    )


def _segment_statements(suffix: str, limits: tuple[int, int, int]) -> dict[str, str]:
    grouped = f", g AS (SELECT *, {_segment(*limits)} AS segment FROM spend)"
    return {
        f"q02_04_customer_segments{suffix}": q(
            grouped + " SELECT customer_name, segment FROM g JOIN buyer USING (customer_id)"
        ),
        f"q02_06_order_value_by_segment{suffix}": q(
            grouped + f" SELECT segment, {each('sum(b.cents)', 'count(*)')} AS average_order_value"
            " FROM kept_basket b JOIN g USING (customer_id) GROUP BY 1 ORDER BY 2 DESC"
        ),
        f"q02_07_revenue_by_segment{suffix}": q(
            grouped + f" SELECT segment, {money('sum(cents)')} AS revenue,"
            f" {pct('sum(cents)', '(SELECT sum(cents) FROM g)')} AS share_percent"
            " FROM g GROUP BY 1 ORDER BY 3 DESC"
        ),
    }


def _lifecycle(short: int, mid: int) -> str:
    return q(
        ", c AS (SELECT customer_id, count(*) AS orders, max(order_date) AS last_order,"
        " min(order_date) AS first_order,"
        " date_diff('day', min(order_date), max(order_date)) AS gap_days"
        " FROM kept_purchase GROUP BY customer_id)"
        " SELECT *, CASE WHEN orders = 1 AND gap_days = 0 THEN 'One Time Buyer'"
        " WHEN gap_days = 0 THEN 'Same Day Repeat Buyer'"
        f" WHEN gap_days < {short} THEN 'Short-term Buyer' WHEN gap_days < {mid} THEN 'Mid-term Buyer'"
        " ELSE 'Long-term Buyer' END AS buyer_type FROM c ORDER BY gap_days DESC"
    )


def _active(min_orders: int) -> str:
    return q(
        ", often AS (SELECT customer_id FROM kept_purchase GROUP BY customer_id"
        f" HAVING count(*) >= {min_orders})"
        ", t AS (SELECT sum(cents) AS total,"
        " sum(if(customer_id IN (FROM often), cents, 0)) AS active FROM spend)"
        f" SELECT {money('total')} AS total_revenue, {money('active')} AS active_revenue,"
        f" {pct('active', 'total')} AS active_percent FROM t"
    )


def _returners(at_least: int) -> str:
    return q(
        " SELECT customer_id, customer_name, count(*) FILTER (is_returned) AS returned_orders,"
        " count(*) AS total_orders,"
        f" {pct('count(*) FILTER (is_returned)', 'count(*)')} AS return_rate_percent"
        " FROM purchase JOIN buyer USING (customer_id) GROUP BY 1, 2"
        f" HAVING count(*) FILTER (is_returned) >= {at_least} ORDER BY 5 DESC"
    )


_RANKED = (
    ", r AS (SELECT *, dense_rank() OVER (ORDER BY cents DESC) AS spend_rank FROM spend)"
)
_FREQUENCY = ", f AS (SELECT customer_id, count(*) AS n FROM kept_purchase GROUP BY 1)"
_KIND = "if(n = 1, 'New Customer', 'Repeat Customer') AS customer_type"

SQL = {
    "q02_01a_top_customers": q(
        f" SELECT customer_id, customer_name, {money('cents')} AS total_spent"
        " FROM spend JOIN buyer USING (customer_id) ORDER BY cents DESC, customer_id LIMIT 10"
    ),
    "q02_01b_top_customers_ranked": q(
        _RANKED + f" SELECT customer_id, customer_name, {money('cents')} AS total_spent, spend_rank"
        " FROM r JOIN buyer USING (customer_id) WHERE spend_rank <= 10"
    ),
    "q02_01c_top_customers_contribution": q(
        _RANKED + f" SELECT customer_id, customer_name, {money('cents')} AS total_spent,"
        f" {pct('cents', '(SELECT sum(cents) FROM spend)')} AS share_percent, spend_rank"
        " FROM r JOIN buyer USING (customer_id) WHERE spend_rank <= 10"
    ),
    "q02_02_repeat_customer_rate": q(
        _FREQUENCY + f" SELECT {pct('count(*) FILTER (n > 1)', 'count(*)')}"
        " AS repeat_customer_percent FROM f"
    ),
    "q02_03_gap_between_orders_by_region": q(
        ", g AS (SELECT region_name, date_diff('day', lag(order_date) OVER"
        " (PARTITION BY customer_id ORDER BY order_date, order_id), order_date) AS days"
        " FROM purchase JOIN buyer USING (customer_id))"
        f" SELECT region_name, {ratio('sum(days)', 'count(days)')} AS average_days"
        " FROM g GROUP BY 1 ORDER BY 2"
    ),
    **_segment_statements("", (1500, 1000, 500)),
    **_segment_statements("_scaled", (850000, 600000, 400000)),
    "q02_05_customer_lifetime_value": q(
        f" SELECT customer_id, customer_name, {money('cents')} AS lifetime_value"
        " FROM spend JOIN buyer USING (customer_id) ORDER BY 3 DESC"
    ),
    "q02_08_new_and_repeat_revenue": q(
        _FREQUENCY + f", t AS (SELECT {_KIND}, sum(cents) AS cents"
        " FROM kept_basket JOIN f USING (customer_id) GROUP BY 1)"
        f" SELECT customer_type, {money('cents')} AS revenue,"
        f" {pct('cents', '(SELECT sum(cents) FROM t)')} AS share_percent FROM t"
    ),
    "q02_09_order_frequency_rank": q(
        _FREQUENCY + " SELECT customer_id, n AS orders,"
        " dense_rank() OVER (ORDER BY n DESC) AS frequency_rank FROM f"
    ),
    "q06_03_frequent_returners": _returners(4),
    "q06_03_frequent_returners_scaled": _returners(8),
    "q06_06_return_rate_of_new_and_repeat": q(
        ", f AS (SELECT customer_id, count(*) AS n FROM purchase GROUP BY 1)"
        f" SELECT {_KIND}, count(*) FILTER (is_returned) AS returned_orders,"
        " count(*) AS total_orders,"
        f" {pct('count(*) FILTER (is_returned)', 'count(*)')} AS return_rate_percent"
        " FROM purchase JOIN f USING (customer_id) GROUP BY 1 ORDER BY 4 DESC"
    ),
    "q11_01_top_decile_of_customers": q(
        ", d AS (SELECT cents, ntile(10) OVER (ORDER BY cents DESC, customer_id) AS tile"
        " FROM spend)"
        f" SELECT {money('sum(cents)')} AS total_revenue,"
        f" {money('sum(cents) FILTER (tile = 1)')} AS top_revenue,"
        f" {pct('sum(cents) FILTER (tile = 1)', 'sum(cents)')} AS top_percent FROM d"
    ),
    "q11_04_order_concentration": q(
        ", d AS (SELECT cents, ntile(10) OVER (ORDER BY cents DESC, order_id) AS tile"
        " FROM kept_basket)"
        " SELECT CASE WHEN tile < 2 THEN 'High-value orders'"
        " WHEN tile < 6 THEN 'Medium-value orders' ELSE 'Low-value orders' END AS order_type,"
        f" {pct('sum(cents)', '(SELECT sum(cents) FROM d)')} AS share_percent"
        " FROM d GROUP BY 1 ORDER BY 2 DESC"
    ),
    "q12_01_orders_per_customer": q(
        f" SELECT {ratio('count(*)', 'count(DISTINCT customer_id)')} AS average_orders"
        " FROM purchase"
    ),
    "q12_02_inactive_customers": q(
        _FREQUENCY + " SELECT count(*) AS customers, count(*) FILTER (n = 1) AS inactive,"
        " count(*) FILTER (n > 1) AS active,"
        f" {pct('count(*) FILTER (n = 1)', 'count(*)')} AS inactive_percent,"
        f" {pct('count(*) FILTER (n > 1)', 'count(*)')} AS active_percent FROM f"
    ),
    "q12_03_customer_lifecycle": _lifecycle(30, 180),
    "q12_03_customer_lifecycle_scaled": _lifecycle(365, 1460),
    "q12_04_highly_active_customers": _active(5),
    "q12_04_highly_active_customers_scaled": _active(10),
}
