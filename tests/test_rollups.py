"""Reports from stored sums against those from raw lines."""

from __future__ import annotations

import os
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import final_plan, rows
from tallyhouse.operators import facts
from tallyhouse.plans import PLANS
from tallyhouse.sources.rollups import refresh_rollups, with_rollups, write_rollups
from tallyhouse.sources.tables import from_frames, load_star

FOLDER = "/root/testdata/sf0.001"
#: Reports of every kind that reads the stored sums.
READERS = ("q01", "q02_01", "q03_01", "q03_02a", "q03_07", "q03_08", "q05_04", "q06_05", "q09_03", "q11", "q12_04")
NAMES = ("regions", "customers", "products", "orders", "lines")


def text(row) -> tuple:
    return tuple((x is None, str(x)) for x in row)


def same(a, b) -> bool:
    return sorted(rows(a), key=text) == sorted(rows(b), key=text)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sums"))
    write_rollups(load_star(spark, FOLDER), f"{path}/sums")
    return f"{path}/sums"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(n for n in PLANS if n.startswith(READERS)))
def test_reports_agree(spark, folder, name):
    star = load_star(spark, FOLDER)
    assert same(PLANS[name](with_rollups(star, folder)), PLANS[name](star))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("start", ["q01_03", "q01_08", "q03_02a", "q03_08", "q11_01", "q02_01a"])
def test_no_line_is_read(spark, folder, start):
    (report,) = [n for n in PLANS if n.startswith(start)]
    assert "l_orderkey" not in final_plan(PLANS[report](with_rollups(load_star(spark, FOLDER), folder)))


def faulty(shop):
    """Lines without order or product, orders without lines, flag or date, negative quantities."""
    t = shop(
        customers=[(1, 1), (2, 1)],
        products=[(1, "2.00"), (2, None), (3, "5.00")],
        orders=[(1, 1, "2024-01-05"), (2, 2, "2024-02-05", True), (3, 1, "2024-02-09", None), (4, 2, "2024-03-01"), (6, 1, "2024-03-09")],
        lines=[(1, 1, 3), (1, 2, 1), (1, 9, 7), (2, 1, 4), (2, 3, -1), (3, 3, 2), (8, 1, 6), (None, 1, 5), (6, 9, 1), (1, None, 2)],
    )
    dateless = t.orders.withColumn("order_date", F.when(F.col("order_id") != 3, F.col("order_date")))
    return from_frames(orders=dateless, **{n: getattr(t, n) for n in NAMES if n != "orders"})


def facts_of(t):
    for returns in (facts.ALL, facts.NET, facts.RETURNED):
        yield facts.order_fact(t, returns)
        yield facts.product_fact(t, returns)
        yield facts.product_months(t, returns).where("quantity <> 0")
    yield facts.order_quantities(t).where("order_id IS NOT NULL")


def test_unsound_rows_count_as_in_raw_lines(shop, tmp_path):
    t = faulty(shop)
    write_rollups(t, str(tmp_path / "s"))
    for k, (a, b) in enumerate(zip(facts_of(with_rollups(t, str(tmp_path / "s"))), facts_of(t), strict=True)):
        assert same(a.select(*b.columns), b), k


def files(folder: str) -> dict[str, set[tuple[str, int]]]:
    return {
        part.name: {(f.name, f.stat().st_mtime_ns) for f in part.glob("*.parquet")}
        for part in Path(folder).glob("order_sums/order_month=*")
    }


def test_a_late_order_changes_only_its_month(shop, spark, tmp_path):
    folder = str(tmp_path / "s")
    orders = [(k, 1, f"2024-{1 + k % 4:02d}-10") for k in range(1, 40)]
    t = shop(orders=orders, lines=[(k, 1, k) for k in range(1, 40)])
    write_rollups(t, folder)
    before = files(folder)
    late = shop(orders=[*orders, (99, 1, "2024-02-28")], lines=[*((k, 1, k) for k in range(1, 40)), (99, 1, 1000)])
    refresh_rollups(late, folder, [date(2024, 2, 28)])
    after = files(folder)
    assert {m for m in before if before[m] != after[m]} == {"order_month=2024-02-01"}
    for name in ("q01_03_revenue_by_month", "q01_01_total_revenue", "q03_08_declining_products"):
        assert same(PLANS[name](with_rollups(late, folder)), PLANS[name](late))
    refresh_rollups(late, folder, [])
    assert files(folder) == after


def test_empty_tables(shop, tmp_path):
    t = shop()
    write_rollups(t, str(tmp_path / "s"))
    rolled = with_rollups(t, str(tmp_path / "s"))
    assert rows(facts.order_fact(rolled)) == rows(facts.product_fact(rolled)) == []
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_rollups(t, str(tmp_path / "s"))
