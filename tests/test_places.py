"""Places in string order against plain windows."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import final_plan, rows
from tallyhouse.operators.places import with_places
from tallyhouse.plans import sales


@pytest.mark.parametrize("splits", [1, 3, 255])
def test_places_equal_a_plain_window(spark, splits):
    draw = random.Random(3)
    names = [None, "", "a", "aa", "ab", "b", "é", "Ä", "z" * 50, "\U0001f600", *(f"p{draw.randrange(500):03d}" for _ in range(300))]
    data = [(g, n) for g in (1, 2) for n in dict.fromkeys(names[g * 3 - 3 :])]
    frame = spark.createDataFrame(data, "g long, n string").repartition(4)
    plain = frame.select("g", "n", F.row_number().over(Window.partitionBy("g").orderBy("n")).cast("long"))
    order = lambda r: (r[0], r[2])
    assert sorted(rows(with_places(frame, "g", "n", "place", splits)), key=order) == sorted(rows(plain), key=order)


def test_places_of_equal_names_and_of_no_rows(spark):
    frame = spark.createDataFrame([(1, "a")] * 4 + [(1, "b")], "g long, n string")
    assert sorted(rows(with_places(frame, "g", "n", "place", 2))) == [(1, "a", k) for k in (1, 2, 3, 4)] + [(1, "b", 5)]
    assert rows(with_places(frame.where("g > 5"), "g", "n", "place")) == []


def many_names(shop, spark, names: int):
    t = shop(orders=[(1,)], lines=[])
    products = spark.range(names + 2).select(
        F.col("id").alias("product_id"),
        F.concat(F.lit("p"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("product_name"),
        F.lit("A").alias("category"),
        F.when(F.col("id") < names, "1.00").when(F.col("id") == names, "5.00").cast("decimal(10,2)").alias("price"),
    )
    lines = spark.range(names + 2).select(F.lit(1).cast("long").alias("order_id"), F.col("id").alias("product_id"), F.lit(1).alias("quantity"))
    t._opened.update(products=products, lines=lines)
    return t


def test_many_names_of_one_value_share_no_task(shop, spark, settings):
    names = 300_000
    settings(spark__sql__shuffle__partitions="16", spark__sql__adaptive__coalescePartitions__enabled="false")
    found = sales.top_product_contribution(many_names(shop, spark, names))
    plan = final_plan(found.where("revenue_rank = 2").groupBy().count())
    # windows without a partition: over the ranks of the k values, nothing else
    alone = [line for line in plan.splitlines() if "Window [" in line and "windowspecdefinition(_range" not in line]
    assert all("revenue_rank" in line or "_value" in line or "cents" not in line for line in alone)
    top = found.where("product_name IN ('p0000000', 'p0000001', 'p0150000', 'p0299999', 'p0300000')").collect()
    total = names + 5
    assert [(r["product_name"], r["revenue"], r["revenue_rank"], round(r["running_percent"] * total / 100)) for r in top] == [
        ("p0300000", Decimal("5.00"), 1, 5),
        ("p0000000", Decimal("1.00"), 2, 6),
        ("p0000001", Decimal("1.00"), 2, 7),
        ("p0150000", Decimal("1.00"), 2, 150_006),
        ("p0299999", Decimal("1.00"), 2, 300_005),
    ]


def test_largest_window_of_tied_names_is_a_small_part(spark):
    frame = spark.range(100_000).select(F.lit(1).cast("long").alias("g"), F.md5(F.col("id").cast("string")).alias("n"))
    from tallyhouse.operators.places import splitters

    split = frame.withColumn("s", splitters(frame, "n"))
    held = split.groupBy(F.size(F.filter("s", lambda s: s <= F.col("n")))).count()
    assert held.agg(F.max("count")).first()[0] < 100_000 / 255 * 12
