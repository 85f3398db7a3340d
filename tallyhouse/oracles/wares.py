"""Expected results: products, categories and baskets."""

from __future__ import annotations

from tallyhouse.oracles.sql import big, each, growth, money, pct, q, ratio

_SOLD = (
    ", sold AS (SELECT product_id, product_name, sum(quantity) AS quantity, sum(cents) AS cents"
    " FROM kept GROUP BY ALL)"
)


def _category_growth(select: str, partition: str, before: str = "") -> str:
    return q(
        ", c AS (SELECT category, m, sum(cents) AS cents FROM kept GROUP BY ALL)"
        f", s AS (SELECT *, lag(cents) OVER (PARTITION BY {partition} ORDER BY m) AS before FROM c)"
        f" SELECT category, {select}, {money('cents')} AS revenue,{before}"
        f" {growth('cents')} AS growth_percent FROM s"
    )


def _return_rate(keys: str) -> str:
    returned = "count(DISTINCT order_id) FILTER (is_returned)"
    return q(
        f" SELECT {keys}, {returned} AS returned_orders, count(DISTINCT order_id) AS total_orders,"
        f" {pct(returned, 'count(DISTINCT order_id)')} AS return_rate_percent"
        f" FROM sale GROUP BY ALL ORDER BY return_rate_percent DESC"
    )


def _single(limit: int, few: str, many: str) -> str:
    return q(
        f" SELECT if(quantity BETWEEN 1 AND {limit}, '{few}', '{many}') AS order_type,"
        f" {money('sum(cents)')} AS revenue FROM kept_basket GROUP BY 1"
    )


def _sizes(edges: tuple[int, ...], names: tuple[str, ...]) -> str:
    steps = " ".join(f"WHEN quantity <= {e} THEN '{n}'" for e, n in zip(edges, names))
    return q(
        f" SELECT CASE WHEN quantity < 1 THEN '{names[-1]}' {steps} ELSE '{names[-1]}' END"
        " AS basket_size, count(*) AS orders,"
        f" {each('sum(cents)', 'count(*)')} AS average_order_value,"
        f" {money('sum(cents)')} AS revenue FROM kept_basket GROUP BY 1 ORDER BY 4 DESC"
    )


SQL = {
    "q03_01_top_products_by_quantity": q(
        _SOLD + f" SELECT product_id, product_name, {big('quantity')} AS quantity,"
        " dense_rank() OVER (ORDER BY quantity DESC) AS quantity_rank"
        " FROM sold QUALIFY quantity_rank <= 10"
    ),
    "q03_02a_top_products_by_revenue": q(
        _SOLD + f" SELECT product_id, product_name, {money('cents')} AS revenue,"
        f" {pct('cents', '(SELECT sum(cents) FROM sold)')} AS share_percent,"
        " dense_rank() OVER (ORDER BY cents DESC) AS revenue_rank"
        " FROM sold QUALIFY revenue_rank <= 10"
    ),
    "q03_02b_product_rank_by_region": q(
        ", r AS (SELECT region_name, product_id, product_name, sum(cents) AS cents"
        " FROM kept GROUP BY ALL)"
        f" SELECT region_name, product_id, product_name, {money('cents')} AS revenue,"
        " dense_rank() OVER (PARTITION BY region_name ORDER BY cents DESC) AS region_rank FROM r"
    ),
    "top_products_by_region": q(
        ", r AS (SELECT region_name, product_id, product_name, sum(cents) AS cents"
        " FROM kept GROUP BY ALL)"
        f" SELECT region_name, product_id, product_name, {money('cents')} AS revenue,"
        " dense_rank() OVER (PARTITION BY region_name ORDER BY cents DESC) AS region_rank FROM r"
        " QUALIFY region_rank <= 3"
    ),
    "top_products_by_category": q(
        ", r AS (SELECT category, product_id, product_name, sum(cents) AS cents"
        " FROM kept GROUP BY ALL)"
        f" SELECT category, product_id, product_name, {money('cents')} AS revenue,"
        " dense_rank() OVER (PARTITION BY category ORDER BY cents DESC) AS category_rank FROM r"
        " QUALIFY category_rank <= 3"
    ),
    "q03_03_return_rate_by_product": _return_rate("product_id, product_name"),
    "q03_04_return_rate_by_category": _return_rate("category"),
    "q06_01_return_rate_by_category": _return_rate("category"),
    "q06_02b_return_rate_by_region_and_category": _return_rate(
        "region_id, region_name, category"
    ),
    "q03_06a_category_growth_by_month": _category_growth(
        "strftime(m, '%Y-%m') AS month", "category"
    ),
    "q03_06b_category_growth_by_year": q(
        ", c AS (SELECT category, year(m) AS year, sum(cents) AS cents FROM kept GROUP BY ALL)"
        ", s AS (SELECT *, lag(cents) OVER (PARTITION BY category ORDER BY year) AS before FROM c)"
        f" SELECT category, year, {money('cents')} AS revenue,"
        f" {growth('cents')} AS growth_percent FROM s"
    ),
    "q03_06c_category_growth_by_month_of_year": _category_growth(
        "year(m) AS year, month(m) AS month",
        "category, month(m)",
        f" {money('before')} AS previous_revenue,",
    ),
    "q03_07_pareto_products": q(
        ", p AS (SELECT product_id, product_name, sum(cents) AS cents FROM sale GROUP BY ALL)"
        ", s AS (SELECT *, sum(cents) OVER (ORDER BY cents DESC RANGE UNBOUNDED PRECEDING)"
        " AS running, sum(cents) OVER () AS overall FROM p)"
        f" SELECT product_id, product_name, {money('cents')} AS revenue,"
        f" {money('running')} AS running_revenue, {money('overall')} AS total_revenue,"
        f" {pct('running', 'overall')} AS running_percent"
        " FROM s WHERE running * 100 <= overall * 80"
    ),
    "q03_08_declining_products": q(
        ", d AS (SELECT product_id, product_name, sum(cents)"
        " - lag(sum(cents)) OVER (PARTITION BY product_id ORDER BY m) AS change"
        " FROM kept GROUP BY product_id, product_name, m)"
        " SELECT product_id, product_name FROM d GROUP BY ALL HAVING min(change) < 0"
    ),
    "q03_09_order_quantity_by_product": q(
        " SELECT product_id, product_name,"
        f" {ratio('sum(quantity)', 'count(DISTINCT order_id)')} AS average_quantity"
        " FROM kept GROUP BY ALL ORDER BY 3 DESC"
    ),
    "q03_10_price_or_volume_driven": q(
        ", c AS (SELECT category, sum(quantity) AS n, sum(cents) AS cents FROM kept GROUP BY ALL)"
        ", t AS (SELECT *, sum(n) OVER () AS all_n, sum(cents) OVER () AS all_cents FROM c)"
        f" SELECT category, {big('n')} AS quantity, {money('cents')} AS revenue,"
        f" {pct('n', 'all_n')} AS quantity_percent, {pct('cents', 'all_cents')} AS revenue_percent,"
        " CASE sign(cents * all_n - n * all_cents) WHEN 1 THEN 'Price Driven'"
        " WHEN -1 THEN 'Volume Driven' ELSE 'Balanced' END AS category_type FROM t"
    ),
    "q06_05_return_impact_by_product": q(
        ", p AS (SELECT product_id, product_name, sum(cents) AS cents,"
        " coalesce(sum(cents) FILTER (is_returned), 0) AS lost FROM sale GROUP BY ALL)"
        f" SELECT product_id, product_name, {money('lost')} AS returned_revenue,"
        f" {money('cents')} AS total_revenue, {pct('lost', 'cents')} AS returned_percent FROM p"
    ),
    "q09_01_items_per_order": q(
        f" SELECT {ratio('sum(quantity)', 'count(DISTINCT order_id)')} AS average_items FROM line"
    ),
    "q09_02_category_combinations": q(
        ", s AS (SELECT list_sort(list_distinct(list(category))) AS items"
        " FROM line JOIN item USING (product_id) GROUP BY order_id)"
        " SELECT array_to_string(items, ', ') AS combination, count(*) AS orders"
        " FROM s WHERE len(items) > 1 GROUP BY combination ORDER BY 2 DESC"
    ),
    "q09_03_single_and_multi_item_revenue": _single(1, 'Single-item Order', 'Multi-item Order'),
    "q09_03_single_and_multi_item_revenue_scaled": _single(50, 'Order of 1 to 50 items', 'Other order'),
    "q09_04_basket_types": q(
        ", t AS (SELECT *, quantity * count(*) OVER () >= sum(quantity) OVER () AS large,"
        " cents * CAST(count(*) OVER () AS HUGEINT) >= sum(cents) OVER () AS dear"
        " FROM kept_basket)"
        f" SELECT order_id, quantity, {money('cents')} AS order_value,"
        " CASE WHEN large AND dear THEN 'High Quantity & High Value'"
        " WHEN large THEN 'High Quantity Basket' WHEN dear THEN 'High Value Basket'"
        " ELSE 'Normal Basket' END AS basket_type FROM t"
    ),
    "q09_05_order_value_by_basket_size": _sizes(
        (1, 3, 5, 10), ("1 Item", "2-3 Items", "4-5 Items", "6-10 Items", "10+ Items")
    ),
    "q09_05_order_value_by_basket_size_scaled": _sizes(
        (1, 50, 100, 150),
        ("1 Item", "2-50 Items", "51-100 Items", "101-150 Items", "150+ Items"),
    ),
    "q11_02_top_products_share": q(
        _SOLD + ", r AS (SELECT cents, dense_rank() OVER (ORDER BY cents DESC) AS place FROM sold)"
        f" SELECT {money('sum(cents)')} AS total_revenue,"
        f" {money('sum(cents) FILTER (place <= 10)')} AS top_revenue,"
        f" {pct('sum(cents) FILTER (place <= 10)', 'sum(cents)')} AS top_percent FROM r"
    ),
    "q11_03_long_tail_of_products": q(
        _SOLD + ", s AS (SELECT cents, sum(cents) OVER (ORDER BY cents DESC"
        " RANGE UNBOUNDED PRECEDING) AS running, sum(cents) OVER () AS overall FROM sold)"
        f" SELECT {pct('sum(cents) FILTER (running * 100 > overall * 80)', 'max(overall)')}"
        " AS tail_percent FROM s"
    ),
    "q11_05_top_categories_share": q(
        ", c AS (SELECT category, sum(cents) AS cents FROM kept GROUP BY ALL)"
        ", t AS (SELECT cents, ntile(3) OVER (ORDER BY cents DESC, category) AS third FROM c)"
        f" SELECT {pct('sum(cents) FILTER (third = 1)', 'sum(cents)')} AS top_percent FROM t"
    ),
}
