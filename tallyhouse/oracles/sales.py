"""Expected results: general sales and time."""

from __future__ import annotations

from tallyhouse.oracles.sql import big, each, growth, mean, money, pct, q

_MONTHS = ", months AS (SELECT m, sum(cents) AS cents FROM sale GROUP BY m)"
_RECENT = """, recent AS (
  SELECT m, sum(cents) AS cents FROM kept
  WHERE order_date >= (SELECT max(order_date) FROM purchase) - INTERVAL 12 MONTH GROUP BY m
)"""
_ORDER_MONTHS = """, volume AS (
  SELECT m, n, lag(n) OVER (ORDER BY m) AS before
  FROM (SELECT m, count(*) AS n FROM kept_purchase GROUP BY m)
)"""

def _sums(table: str, source: str, **columns: str) -> str:
    """What each column of a table holds, as rows, followed by a UNION ALL."""
    return "".join(
        f" SELECT '{table}.{name}' AS column_name, count({name if name != 'price' else 'price_cents'}) AS filled,"
        f" CAST(coalesce(sum({number}), 0) AS BIGINT) AS total FROM {source} UNION ALL"
        for name, number in columns.items()
    )


SQL = {
    "q01_01_total_revenue": q(f" SELECT {money('sum(cents)')} AS revenue FROM sale"),
    "q01_02_net_revenue": q(f" SELECT {money('sum(cents)')} AS revenue FROM kept"),
    "q01_03_revenue_by_month": q(
        f" SELECT year(m) AS year, month(m) AS month, {money('sum(cents)')} AS revenue"
        " FROM sale GROUP BY m ORDER BY m DESC"
    ),
    "ingest_rollups": q(
        f" SELECT year(m) AS year, month(m) AS month, {money('sum(cents)')} AS revenue"
        " FROM sale GROUP BY m ORDER BY m DESC"
    ),
    "q01_04a_revenue_by_product_name": q(
        f" SELECT product_name, category, {money('sum(cents)')} AS revenue"
        " FROM sale GROUP BY ALL ORDER BY 2, 3 DESC"
    ),
    "q01_04b_revenue_by_category": q(
        f" SELECT category, {money('sum(cents)')} AS revenue FROM sale GROUP BY ALL ORDER BY 2 DESC"
    ),
    "q01_05_average_order_value": q(
        f" SELECT {mean('sum(cents)', 'count(*)')} AS average_order_value FROM basket"
    ),
    "q01_06_average_order_value_by_month": q(
        " SELECT year(m) AS year, month(m) AS month,"
        f" {mean('sum(cents)', 'count(*)')} AS average_order_value"
        " FROM basket GROUP BY m ORDER BY m DESC"
    ),
    "q01_07_average_order_size_by_region": q(
        " SELECT region_name,"
        " CAST(sum(quantity) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS average_items"
        " FROM basket GROUP BY ALL ORDER BY 2 DESC"
    ),
    "q01_08_gross_net_returned": q(
        ", t AS (SELECT sum(cents) AS g, sum(cents) FILTER (NOT is_returned) AS n,"
        " sum(cents) FILTER (is_returned) AS r FROM sale)"
        f" SELECT {money('g')} AS gross_revenue, {money('n')} AS net_revenue,"
        f" {money('r')} AS returned_revenue, {pct('r', 'g')} AS returned_percent FROM t"
    ),
    "q01_09a_growth_by_month": q(
        _MONTHS + ", s AS (SELECT *, lag(cents) OVER (ORDER BY m) AS before FROM months)"
        f" SELECT strftime(m, '%Y-%m') AS month, {money('cents')} AS revenue,"
        f" {money('before')} AS previous_revenue, {growth('cents')} AS growth_percent"
        " FROM s ORDER BY m"
    ),
    "q01_09b_growth_by_year": q(
        ", s AS (SELECT year(m) AS year, sum(cents) AS cents,"
        " lag(sum(cents)) OVER (ORDER BY year(m)) AS before FROM sale GROUP BY year(m))"
        f" SELECT year, {money('cents')} AS revenue, {money('before')} AS previous_revenue,"
        f" {growth('cents')} AS growth_percent FROM s ORDER BY 1"
    ),
    "q01_09c_growth_by_month_of_year": q(
        _MONTHS + ", s AS (SELECT *, lag(cents) OVER (PARTITION BY month(m) ORDER BY m) AS before"
        " FROM months)"
        " SELECT year(m) AS year, month(m) AS month, strftime(m, '%Y-%m') AS year_month,"
        f" {money('cents')} AS revenue, {money('before')} AS previous_revenue,"
        f" {growth('cents')} AS growth_percent FROM s"
    ),
    "q01_10_extreme_months": q(
        _MONTHS + f" SELECT strftime(m, '%Y-%m') AS year_month, {money('cents')} AS revenue"
        " FROM months WHERE cents IN ((SELECT max(cents) FROM months),"
        " (SELECT min(cents) FROM months))"
    ),
    "q01_11a_category_contribution": q(
        ", c AS (SELECT category, sum(cents) AS cents FROM sale GROUP BY ALL)"
        f" SELECT category, {money('cents')} AS revenue,"
        f" {pct('cents', '(SELECT sum(cents) FROM c)')} AS share_percent,"
        " dense_rank() OVER (ORDER BY cents DESC) AS revenue_rank FROM c ORDER BY 4"
    ),
    "q01_11b_top_product_contribution": q(
        ", p AS (SELECT product_name, sum(cents) AS cents FROM sale GROUP BY ALL)"
        ", r AS (SELECT *, dense_rank() OVER (ORDER BY cents DESC) AS revenue_rank,"
        " sum(cents) OVER (ORDER BY cents DESC, product_name ROWS UNBOUNDED PRECEDING) AS running,"
        " (SELECT sum(cents) FROM p) AS overall FROM p)"
        f" SELECT product_name, {money('cents')} AS revenue,"
        f" {pct('cents', 'overall')} AS share_percent,"
        " CAST(running AS DOUBLE) / CAST(overall AS DOUBLE) * 100 AS running_percent,"
        " revenue_rank FROM r WHERE revenue_rank <= 10 ORDER BY 5, 1"
    ),
    "q04_01a_last_year_by_month": q(
        _RECENT + f" SELECT year(m) AS year, month(m) AS month, {money('cents')} AS revenue"
        " FROM recent ORDER BY 1, 2"
    ),
    "ingest_by_month": q(
        _RECENT + f" SELECT year(m) AS year, month(m) AS month, {money('cents')} AS revenue"
        " FROM recent ORDER BY 1, 2"
    ),
    "q04_01b_last_year_growth": q(
        _RECENT + ", s AS (SELECT *, lag(cents) OVER (ORDER BY m) AS before FROM recent)"
        f" SELECT strftime(m, '%Y-%m') AS month, {money('cents')} AS revenue,"
        f" {money('before')} AS previous_revenue, {growth('cents')} AS growth_percent"
        " FROM s ORDER BY m"
    ),
    "q04_02_order_value_by_month": q(
        " SELECT strftime(m, '%Y-%m') AS month,"
        f" {each('sum(cents)', 'count(*)')} AS average_order_value"
        " FROM kept_basket GROUP BY m ORDER BY m"
    ),
    "q04_03_order_volume_growth": q(
        _ORDER_MONTHS + " SELECT strftime(m, '%Y-%m') AS month, n AS orders,"
        f" {growth('n')} AS growth_percent FROM volume ORDER BY m"
    ),
    "q04_04_seasons": q(
        ", c AS (SELECT month(m) AS month, monthname(m) AS month_name, sum(cents) AS cents"
        " FROM kept GROUP BY ALL)"
        ", t AS (SELECT *, ntile(4) OVER (ORDER BY cents DESC, month) AS quarter FROM c)"
        f" SELECT month, month_name, {money('cents')} AS revenue,"
        " list_extract(['Peak Season', 'Normal', 'Normal', 'Off-Season'], quarter) AS season_type"
        " FROM t ORDER BY cents DESC"
    ),
    "q04_05_weekday_and_weekend": q(
        " SELECT if(dayofweek(order_date) IN (0, 6), 'Weekend', 'Weekday') AS day_type,"
        f" {money('sum(cents)')} AS revenue, count(*) AS orders,"
        f" {each('sum(cents)', 'count(*)')} AS average_order_value"
        " FROM kept_basket GROUP BY 1 ORDER BY 2 DESC"
    ),
    "q12_05_order_frequency": q(
        _ORDER_MONTHS + " SELECT strftime(m, '%Y-%B') AS month, n AS orders,"
        f" {growth('n')} AS growth_percent FROM volume ORDER BY m"
    ),
    "q08_01_orders_by_status": q(
        " SELECT count(*) AS total_orders, count(*) FILTER (is_returned) AS returned_orders,"
        " count(*) FILTER (NOT is_returned) AS completed_orders FROM purchase"
    ),
    "q08_02_completion_and_return_rate": q(
        f" SELECT {pct('count(*) FILTER (NOT is_returned)', 'count(*)')} AS completion_percent,"
        f" {pct('count(*) FILTER (is_returned)', 'count(*)')} AS return_percent FROM purchase"
    ),
    "q08_05_status_by_month": q(
        " SELECT strftime(m, '%Y-%B') AS month, count(*) AS total_orders,"
        " count(*) FILTER (NOT is_returned) AS completed_orders,"
        " count(*) FILTER (is_returned) AS returned_orders,"
        f" {pct('count(*) FILTER (NOT is_returned)', 'count(*)')} AS completion_percent,"
        f" {pct('count(*) FILTER (is_returned)', 'count(*)')} AS return_percent"
        " FROM purchase GROUP BY m ORDER BY m"
    ),
    "fact_order_lines": q(
        " SELECT order_id, product_id, quantity, product_name, category, customer_id, order_date,"
        f" is_returned, customer_name, region_id, region_name, {money('cents')} AS revenue"
        " FROM sale"
    ),
    "window_order_deciles": q(
        f" SELECT order_id, {money('cents')} AS order_value,"
        " row_number() OVER (ORDER BY cents DESC, order_id) AS position,"
        f" {big('ntile(10) OVER (ORDER BY cents DESC, order_id)')} AS decile FROM kept_basket"
    ),
    "ingest_tables": q(
        _sums("regions", "(SELECT CAST(r_regionkey AS BIGINT) AS region_id, r_name AS region_name FROM region)",
              region_id="region_id", region_name="length(region_name)")
        + _sums("customers", "buyer", customer_id="customer_id", customer_name="length(customer_name)", region_id="region_id")
        + _sums("products", "item", product_id="product_id", product_name="length(product_name)",
                category="length(category)", price="price_cents")
        + _sums("orders", "purchase", order_id="order_id", customer_id="customer_id",
                order_date="date_diff('day', DATE '1970-01-01', order_date)", is_returned="CAST(is_returned AS BIGINT)")
        + _sums("lines", "line", order_id="order_id", product_id="product_id", quantity="quantity")[: -len(" UNION ALL")]
    ),
    "check_violations": q(
        ", f AS (SELECT 'orphan lines.product_id' AS \"check\", product_id AS id,"
        " concat_ws(', ', 'order_id=' || order_id, 'product_id=' || product_id, 'quantity=' || quantity) AS row"
        " FROM line WHERE product_id NOT IN (SELECT product_id FROM item)"
        " UNION ALL SELECT 'orphan lines.order_id', order_id,"
        " concat_ws(', ', 'order_id=' || order_id, 'product_id=' || product_id, 'quantity=' || quantity)"
        " FROM line WHERE order_id NOT IN (SELECT order_id FROM purchase)"
        " UNION ALL SELECT 'orphan orders.customer_id', customer_id, concat_ws(', ', 'order_id=' || order_id,"
        " 'customer_id=' || customer_id, 'order_date=' || order_date, 'is_returned=' || is_returned)"
        " FROM purchase WHERE customer_id NOT IN (SELECT customer_id FROM buyer)"
        " UNION ALL SELECT 'orders without lines', order_id, concat_ws(', ', 'order_id=' || order_id,"
        " 'customer_id=' || customer_id, 'order_date=' || order_date, 'is_returned=' || is_returned)"
        " FROM purchase WHERE order_id NOT IN (SELECT order_id FROM line))"
        ' SELECT "check", CAST(id AS VARCHAR) AS key, row, count(*) AS copies FROM f GROUP BY ALL'
    ),
    "check_integrity": q(
        """
        SELECT 'null regions.region_id' AS "check",
               count(*) - count(r_regionkey) AS violations FROM region
        UNION ALL SELECT 'duplicate regions.region_id',
               count(r_regionkey) - count(DISTINCT r_regionkey) FROM region
        UNION ALL SELECT 'null customers.customer_id',
               count(*) - count(c_custkey) FROM customer
        UNION ALL SELECT 'duplicate customers.customer_id',
               count(c_custkey) - count(DISTINCT c_custkey) FROM customer
        UNION ALL SELECT 'null products.product_id',
               count(*) - count(p_partkey) FROM part
        UNION ALL SELECT 'duplicate products.product_id',
               count(p_partkey) - count(DISTINCT p_partkey) FROM part
        UNION ALL SELECT 'null orders.order_id',
               count(*) - count(o_orderkey) FROM orders
        UNION ALL SELECT 'duplicate orders.order_id',
               count(o_orderkey) - count(DISTINCT o_orderkey) FROM orders
        UNION ALL SELECT 'orphan customers.region_id', count(*) FROM customer
               LEFT JOIN nation ON c_nationkey = n_nationkey
               LEFT JOIN region ON n_regionkey = r_regionkey
               WHERE n_regionkey IS NOT NULL AND r_regionkey IS NULL
        UNION ALL SELECT 'orphan orders.customer_id', count(*) FROM orders
               WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT 'orphan lines.order_id', count(*) FROM lineitem
               WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
        UNION ALL SELECT 'orphan lines.product_id', count(*) FROM lineitem
               WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
        UNION ALL SELECT 'orders without lines', count(*) FROM orders
               WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
        UNION ALL SELECT 'orders without return flag', count(*) FROM orders
               WHERE o_orderstatus IS NULL"""
    ),
}
