"""Pieces of DuckDB SQL the expected results are written with."""

from __future__ import annotations

# Views over the physical tables. ``sale`` has one row per line with everything
# known about it, ``basket`` one row per order with lines; unused ones cost nothing.
PRELUDE = """
WITH item AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 100 AS BIGINT) AS price_cents
  FROM part
), line AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id,
         CAST(CAST(l_quantity AS INT) AS BIGINT) AS quantity
  FROM lineitem
), purchase AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
         o_orderstatus = 'F' AS is_returned
  FROM orders
), buyer AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name,
         CAST(r_regionkey AS BIGINT) AS region_id, r_name AS region_name
  FROM customer, nation, region
  WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey
), sale AS (
  SELECT *, quantity * price_cents AS cents
  FROM line
  JOIN item USING (product_id) JOIN purchase USING (order_id) JOIN buyer USING (customer_id)
), kept AS (
  FROM sale WHERE NOT is_returned
), basket AS (
  SELECT order_id, customer_id, region_name, order_date, m, is_returned,
         CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(cents) AS BIGINT) AS cents
  FROM sale GROUP BY ALL
), kept_basket AS (
  FROM basket WHERE NOT is_returned
), kept_purchase AS (
  FROM purchase WHERE NOT is_returned
), spend AS (
  SELECT customer_id, CAST(sum(cents) AS BIGINT) AS cents, count(*) AS orders
  FROM kept_basket GROUP BY customer_id
)"""


def q(body: str) -> str:
    """A statement over the prelude; body may start with further CTEs after a comma."""
    return f"{PRELUDE}{body}"


def money(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(26,0)) * 0.01 AS DECIMAL(28,2))"


def big(number: str) -> str:
    return f"CAST({number} AS BIGINT)"


def ratio(top: str, bottom: str) -> str:
    """Two decimals, half-up, in whole numbers."""
    n, d = f"CAST({top} AS HUGEINT)", f"NULLIF(CAST({bottom} AS HUGEINT), 0)"
    sign = f"CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END"
    return f"CAST((200 * abs({n}) + abs({d})) // (2 * abs({d})) * {sign} AS DOUBLE) / 100"


def pct(part: str, whole: str) -> str:
    return ratio(f"100 * CAST({part} AS HUGEINT)", whole)


def each(cents: str, count: str) -> str:
    """Currency per item."""
    return ratio(cents, f"100 * ({count})")


def mean(cents: str, count: str) -> str:
    """Unrounded currency per item."""
    return f"CAST({cents} AS DOUBLE) / CAST(NULLIF({count}, 0) AS DOUBLE) / 100"


def growth(value: str) -> str:
    """Against a column named before."""
    return pct(f"({value} - before)", "before")
