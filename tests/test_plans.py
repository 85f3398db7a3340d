"""What the physical plans must and must not do."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import final_plan
from tallyhouse.operators import facts
from tallyhouse.plans import PLANS
from tallyhouse.plans.customers import net_spend
from tallyhouse.sources.tables import load_star

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

SHUFFLED = {"spark__sql__autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def star(spark):
    return load_star(spark, FOLDER)


def formatted(frame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", sorted(PLANS))
def test_no_cross_join_and_no_python(star, name):
    text = formatted(PLANS[name](star))
    for bad in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEvalPython"):
        assert bad not in text


def test_flag_and_columns_reach_the_scan(star):
    text = formatted(PLANS["q01_02_net_revenue"](star))
    assert "Not(EqualTo(o_orderstatus,F))" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_retailprice:double>" in text


def test_a_given_date_reaches_the_scan(star):
    from datetime import date

    from tallyhouse.plans.trends import last_year_by_month

    text = formatted(last_year_by_month(star, date(2001, 8, 1)))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate,2000-08-01", text)


@pytest.mark.parametrize(
    "name, tables",
    [
        ("q01_01_total_revenue", "lp"),
        ("q01_05_average_order_value", "lp"),
        ("q02_02_repeat_customer_rate", "o"),
        ("q02_05_customer_lifetime_value", "lpoc"),
        ("q03_03_return_rate_by_product", "lpo"),
        ("q09_01_items_per_order", "l"),
        ("q12_03_customer_lifecycle", "o"),
        ("q05_03_order_value_by_region", "lpocnr"),
    ],
)
def test_only_needed_tables_are_read(star, name, tables):
    text = PLANS[name](star)._jdf.queryExecution().optimizedPlan().toString()
    read = set(re.findall(r"\b([lpocnr])_[a-z]+#", text))
    assert read == set(tables)


#: Reports that use one fact in several branches or subqueries.
BRANCHED = (
    "q01_11b_top_product_contribution", "q02_01b_top_customers_ranked",
    "q02_01c_top_customers_contribution", "q03_01_top_products_by_quantity",
    "q03_02a_top_products_by_revenue", "q03_02b_product_rank_by_region",
    "q03_07_pareto_products", "q04_01b_last_year_growth", "q09_04_basket_types",
    "q11_01_top_decile_of_customers", "q11_02_top_products_share",
    "q11_03_long_tail_of_products", "q11_04_order_concentration", "window_order_deciles",
)


def executed_scans(frame, first_column: str) -> int:
    """Scans of the table whose columns begin so, in the plan that ran; what is reused counts once."""
    frame.collect()
    count, seen = 0, set()

    def each(nodes):
        for i in range(nodes.size()):
            walk(nodes.apply(i))

    def walk(node):
        nonlocal count
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind in ("ReusedExchangeExec", "ReusedSubqueryExec"):
            return None
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        if kind in ("ShuffleExchangeExec", "BroadcastExchangeExec", "SubqueryExec"):
            if node.id() in seen:
                return None
            seen.add(node.id())
        if kind == "FileSourceScanExec" and f"[{first_column}" in node.toString():
            count += 1
        each(node.subqueries())
        return each(node.children())

    walk(frame._jdf.queryExecution().executedPlan())
    return count


#: The default last year is counted back from the latest order, which is a look at the orders of its own.
TWO_LOOKS = ("q04_01b_last_year_growth",)


@pytest.mark.parametrize("name", BRANCHED)
def test_lines_and_orders_are_scanned_once(spark, star, settings, name):
    """Branches over the same fact share one shuffle."""
    settings(**SHUFFLED)
    assert executed_scans(PLANS[name](star), "l_") == 1
    assert executed_scans(PLANS[name](star), "o_") <= 1 + (name in TWO_LOOKS)


def test_integrity_scans_lines_and_orders_once_for_each_of_their_references(spark, star, settings):
    settings(**SHUFFLED)
    assert executed_scans(PLANS["check_integrity"](star), "l_") == 2
    assert executed_scans(PLANS["check_integrity"](star), "o_") == 2


def test_customers_and_regions_meet_orders_before_lines(star):
    found = []

    def walk(node):
        condition = str(node.condition()) if node.nodeName() == "Join" else ""
        if "customer_id" in condition or "region_id" in condition:
            found.append(node.toString())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(PLANS["fact_order_lines"](star)._jdf.queryExecution().optimizedPlan())
    assert found
    assert not any("l_orderkey" in joined for joined in found)


@pytest.mark.parametrize(
    "name",
    ["q11_01_top_decile_of_customers", "q11_03_long_tail_of_products",
     "q11_04_order_concentration", "q03_07_pareto_products", "q02_09_order_frequency_rank",
     "q03_02b_product_rank_by_region", "window_order_deciles"],
)
def test_windows_over_large_inputs_are_partitioned_by_block(star, name):
    text = PLANS[name](star)._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"Window \[(.*)", text)
    assert any("_block" in w for w in windows)
    # else only the total of a few buckets, over rows that an aggregate left
    for window in windows:
        assert "_block" in window or name == "q11_04_order_concentration"


def test_order_facts_shuffle_lines_twice_and_orders_once(star, settings):
    """Lines to products, lines to orders; the order sums join in place."""
    settings(**SHUFFLED)
    text = facts.order_fact(star)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(product_id", text)) == 2
    assert len(re.findall(r"Exchange hashpartitioning\(order_id", text)) == 2
    assert len(re.findall(r"Exchange ", text)) == 4


def test_customer_value_has_a_map_side_combine(star):
    text = net_spend(star)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"partial_sum", text)) >= 2


HOT = {
    **SHUFFLED,
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "2k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "2k",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__shuffle__partitions": "8",
}


@pytest.fixture(scope="module")
def hot_star(spark, tmp_path_factory):
    """One order and one product with a third of the lines each, one customer with a third of the orders."""
    folder = tmp_path_factory.mktemp("hot")
    n = F.col("id")

    def spread(seed, count):
        return F.pmod(F.xxhash64(n, F.lit(seed)), F.lit(count))

    lines = spark.range(30_000).repartition(8).select(
        F.when(n % 3 == 1, 11).otherwise(spread(0, 4000)).cast("long").alias("l_orderkey"),
        F.when(n % 3 == 0, 5).otherwise(spread(1, 500)).cast("long").alias("l_partkey"),
        (n % 50 + 1).cast("double").alias("l_quantity"),
    )
    orders = spark.range(4000).select(
        n.alias("o_orderkey"),
        F.when(n % 3 == 0, 7).otherwise(n % 300).cast("long").alias("o_custkey"),
        F.when(n % 4 == 0, "F").otherwise("O").alias("o_orderstatus"),
        F.expr("cast(date_add(date'1995-01-01', cast(id % 2400 as int)) as timestamp_ntz)").alias("o_orderdate"),
    )
    parts = spark.range(500).select(
        n.alias("p_partkey"), F.concat(F.lit("n"), n % 50).alias("p_name"),
        F.concat(F.lit("T"), n % 6).alias("p_type"), (F.lit(900) + n / 100).alias("p_retailprice"),
    )
    customers = spark.range(300).select(
        n.alias("c_custkey"), F.concat(F.lit("c"), n).alias("c_name"), (n % 25).cast("int").alias("c_nationkey")
    )
    for name, frame in (("lineitem", lines), ("orders", orders), ("part", parts), ("customer", customers)):
        frame.write.parquet(f"{folder}/{name}.parquet")
    for name in ("nation", "region"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize(
    "name",
    ["q01_03_revenue_by_month", "q03_06a_category_growth_by_month", "q06_05_return_impact_by_product",
     "q03_02b_product_rank_by_region", "q05_05a_category_sales_by_region"],
)
def test_hot_keys_are_split(spark, hot_star, settings, name):
    settings(**HOT)
    assert "skew=true" in final_plan(PLANS[name](load_star(spark, hot_star)))


@pytest.mark.parametrize(
    "name",
    (
        *BRANCHED, "check_integrity", "q01_03_revenue_by_month",
        "q01_04a_revenue_by_product_name", "q01_07_average_order_size_by_region",
        "q02_03_gap_between_orders_by_region", "q02_05_customer_lifetime_value",
        "q02_08_new_and_repeat_revenue", "q02_09_order_frequency_rank",
        "q03_03_return_rate_by_product", "q03_06a_category_growth_by_month",
        "q03_08_declining_products", "q03_09_order_quantity_by_product",
        "q05_05b_category_rank_by_region", "q06_02b_return_rate_by_region_and_category",
        "q06_05_return_impact_by_product", "q09_02_category_combinations",
        "q09_05_order_value_by_basket_size_scaled", "q10_05_growth_by_region",
        "q12_03_customer_lifecycle", "q12_04_highly_active_customers",
    ),
)
def test_hot_keys_change_no_result(spark, hot_star, settings, name):
    import duckdb

    from tallyhouse.oracles import ORACLES

    settings(**HOT)
    frame = PLANS[name](load_star(spark, hot_star))
    duck = duckdb.connect()
    for table in ("region", "nation", "customer", "part", "orders", "lineitem"):
        duck.sql(f"CREATE VIEW {table} AS FROM '{hot_star}/{table}.parquet/*.parquet'")
    expected = duck.sql(ORACLES[name])
    columns = sorted(frame.columns)
    places = [expected.columns.index(c) for c in columns]

    def key(row):
        return [(v is None, 0 if v is None else v) for v in row]

    ours = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=key)
    theirs = sorted((tuple(r[i] for i in places) for r in expected.fetchall()), key=key)
    assert ours == theirs
