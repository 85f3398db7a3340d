"""The layout of orders and lines by month and order."""

from __future__ import annotations

import os
import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import final_plan, rows
from tallyhouse.operators import facts
from tallyhouse.plans import PLANS
from tallyhouse.plans.trends import last_year_by_month
from tallyhouse.sources.layout import load_layout, write_layout
from tallyhouse.sources.tables import NATIVE, load_star

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
REPORTS = sorted(n for n in PLANS if n.startswith(("q01_0", "q04_0", "q05_05", "q06_03", "check", "fact")))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shop") / "by month")
    assert write_layout(load_star(spark, FOLDER), path, buckets=6) == 6
    return path


def same(a, b):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted(rows(a), key=key) == sorted(rows(b), key=key)


def test_tables_are_the_same(spark, folder):
    star, laid = load_star(spark, FOLDER), load_layout(spark, folder)
    for name in NATIVE:
        assert same(getattr(laid, name), getattr(star, name))


@pytest.mark.parametrize("name", REPORTS)
def test_reports_are_the_same(spark, folder, name):
    assert same(PLANS[name](load_layout(spark, folder)), PLANS[name](load_star(spark, FOLDER)))


def exchanges(frame) -> list[str]:
    return re.findall(r"Exchange (?:hash|range)partitioning\(([^)]*)", final_plan(frame))


def test_lines_meet_orders_without_an_exchange(spark, folder, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    wanted = ("order_id", "quantity", "order_date", "is_returned")
    plain = facts.order_line_fact(load_star(spark, FOLDER), facts.NET, wanted)
    laid = facts.order_line_fact(load_layout(spark, folder), facts.NET, wanted)
    assert exchanges(plain) and not exchanges(laid)
    for build in (facts.order_quantities, facts.order_product_fact):
        assert not [x for x in exchanges(build(load_layout(spark, folder))) if "order_id" in x and "product" not in x]


def test_revenue_by_month_shuffles_no_lines(spark, folder, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    laid = load_layout(spark, folder)
    laid._opened["products"] = F.broadcast(laid.products)
    moved = exchanges(PLANS["q01_03_revenue_by_month"](laid))
    assert not [x for x in moved if "order_id" in x or "product_id" in x]


def test_another_session_registers_the_tables_again(spark, folder):
    for name in spark.catalog.listTables():
        if name.name.startswith("tallyhouse_"):
            spark.sql(f"DROP TABLE {name.name}")
    other = load_layout(spark.newSession(), folder)
    assert same(other.lines, load_star(spark, FOLDER).lines)
    assert other.orders.count() == load_star(spark, FOLDER).orders.count()


def broken(folder: str, month: str) -> None:
    """Make the lines of a month unreadable."""
    (part,) = Path(folder).glob(f"lines/order_month={month}")
    for file in part.glob("*.parquet"):
        file.write_bytes(b"not a table")
    for check in part.glob(".*.crc"):
        check.unlink()


@pytest.mark.parametrize("as_of", [None, date(1997, 5, 20)])
def test_older_months_are_not_read(spark, tmp_path, as_of):
    star, path = load_star(spark, FOLDER), str(tmp_path / "shop")
    write_layout(star, path, buckets=2)
    months = sorted(p.name.split("=")[1] for p in Path(path).glob("lines/order_month=*"))
    end = as_of or star.orders.agg(F.max("order_date")).first()[0]
    first = f"{end.year - 1}-{end.month:02d}-01"
    assert months[0] < first
    broken(path, max(m for m in months if m < first))
    laid = load_layout(spark, path)
    assert same(last_year_by_month(laid, as_of), last_year_by_month(star, as_of))
    with pytest.raises(Exception):
        laid.lines.agg(F.sum("quantity")).collect()


def test_an_order_too_large_for_a_bucket_keeps_the_shuffle_join(shop, spark, tmp_path):
    lines = [(1, 1, 1)] * 2000 + [(k, 1, 1) for k in range(2, 1000)] + [(None, 1, 1), (5000, 1, 1)]
    t = shop(orders=[(k, 1, f"2024-{1 + k % 12:02d}-03") for k in range(1, 1000)], lines=lines)
    assert write_layout(t, str(tmp_path / "a"), buckets=8) == 0
    laid = load_layout(spark, str(tmp_path / "a"))
    for name in NATIVE:
        assert same(getattr(laid, name), getattr(t, name))
    assert same(PLANS["q04_01a_last_year_by_month"](laid), PLANS["q04_01a_last_year_by_month"](t))


def test_empty_tables_and_missing_dates(shop, spark, tmp_path):
    for k, t in enumerate((shop(), shop(orders=[(1,)], lines=[(1, 1, 1), (None, 1, 2), (9, 1, 3)]))):
        write_layout(t, str(tmp_path / str(k)), buckets=3)
        laid = load_layout(spark, str(tmp_path / str(k)))
        for name in NATIVE:
            assert same(getattr(laid, name), getattr(t, name))


def test_a_layout_is_not_overwritten(shop, spark, tmp_path):
    write_layout(shop(), str(tmp_path / "x"), buckets=2)
    with pytest.raises(Exception, match="(?i)already.exists"):
        write_layout(shop(), str(tmp_path / "x"), buckets=2)
