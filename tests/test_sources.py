"""Layouts, ingest and the integrity report."""

from __future__ import annotations

import pytest

from conftest import rows
from tallyhouse.operators.integrity import integrity_report, violations
from tallyhouse.plans import PLANS
from tallyhouse.sources.ingest import write_native
from tallyhouse.sources.tables import NATIVE, Tables, from_frames, load_native

SHOP = dict(
    regions=(1, 2),
    customers=[(1, 1), (2, 2)],
    products=[(1, "10.00"), (2, "2.50", "pen", "B")],
    orders=[(1,), (2, 2, "2024-02-01", True)],
    lines=[(1, 1, 2), (1, 2, 1), (2, 2, 4)],
)


def test_written_tables_read_back(shop, spark, tmp_path):
    t = shop(**SHOP)
    write_native(t, str(tmp_path))
    again = load_native(spark, str(tmp_path))
    for name, schema in NATIVE.items():
        frame = getattr(again, name)
        assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in schema]
        assert sorted(rows(frame)) == sorted(rows(getattr(t, name)))
    for report in ("q01_08_gross_net_returned", "q05_04_region_contribution"):
        assert rows(PLANS[report](again)) == rows(PLANS[report](t))


@pytest.mark.parametrize("fmt", ["csv", "json", "orc"])
def test_other_formats(shop, spark, tmp_path, fmt):
    t = shop(**SHOP)
    for name in NATIVE:
        getattr(t, name).write.format(fmt).option("header", True).save(f"{tmp_path}/{name}")
    again = load_native(spark, str(tmp_path), fmt)
    for name in NATIVE:
        assert sorted(rows(getattr(again, name))) == sorted(rows(getattr(t, name)))


def test_csv_flags_extra_columns_and_bad_values(spark, tmp_path):
    (tmp_path / "orders").mkdir()
    target = tmp_path / "orders" / "a.csv"
    target.write_text(
        "note,order_id,customer_id,order_date,is_returned\n"
        "x,1,1,2024-01-01,TRUE\ny,2,1,2024-01-02,0\nz,3,1,2024-01-03,\n"
    )
    orders = load_native(spark, str(tmp_path), "csv").orders
    assert [r[3] for r in sorted(rows(orders))] == [True, False, None]

    target.write_text("order_id,customer_id,order_date,is_returned\n1,one,2024-01-01,TRUE\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load_native(spark, str(tmp_path), "csv").orders.collect()


def test_existing_tables_are_not_overwritten(shop, tmp_path):
    t = shop(**SHOP)
    write_native(t, str(tmp_path))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_native(t, str(tmp_path))


def test_integrity_report_finds_each_fault(shop):
    t = shop(
        regions=(1, 1),
        customers=[(1, 1), (2, 9)],
        products=[(1, "1.00"), (1, "1.00"), (1, "1.00")],
        orders=[(1,), (2, 8), (3, 1, "2024-01-01", None)],
        lines=[(1, 1, 1), (7, 1, 1), (7, 6, 1), (2, 5, 1)],
    )
    assert dict(rows(integrity_report(t))) == {
        "null regions.region_id": 0,
        "null customers.customer_id": 0,
        "null products.product_id": 0,
        "null orders.order_id": 0,
        "duplicate regions.region_id": 1,
        "duplicate customers.customer_id": 0,
        "duplicate products.product_id": 2,
        "duplicate orders.order_id": 0,
        "orphan customers.region_id": 1,
        "orphan orders.customer_id": 1,
        "orphan lines.order_id": 2,
        "orphan lines.product_id": 2,
        "orders without lines": 1,
        "orders without return flag": 1,
    }


def test_integrity_report_of_null_and_line_keys(spark, shop):
    t = shop(
        regions=(1,),
        customers=[(1, 1), (None, 1), (None, None)],
        products=[(1, "1.00"), (None, "1.00")],
        orders=[(1,), (None, None, "2024-01-01", None)],
        lines=[(1, 1, 1), (None, None, 1)],
    )
    found = dict(rows(integrity_report(t)))
    assert {check: n for check, n in found.items() if n} == {
        "null customers.customer_id": 2,
        "null products.product_id": 1,
        "null orders.order_id": 1,
        "orders without lines": 1,
        "orders without return flag": 1,
    }
    numbered = spark.createDataFrame(
        [(5, 1, 1, 1), (5, 1, 1, 1), (None, 1, 1, 1)],
        "order_detail_id long, order_id long, product_id long, quantity int",
    )
    names = ("regions", "customers", "products", "orders")
    keyed = from_frames(lines=numbered, **{name: getattr(t, name) for name in names})
    found = dict(rows(integrity_report(keyed)))
    assert (found["null lines.order_detail_id"], found["duplicate lines.order_detail_id"]) == (1, 1)


def test_a_table_is_opened_once_and_only_when_asked_for():
    opened = []

    def opener(name):
        return lambda: opened.append(name) or name

    t = Tables(orders=opener("orders"), lines=opener("lines"))
    assert (t.orders, t.orders) == ("orders", "orders")
    assert opened == ["orders"]
    with pytest.raises(AttributeError):
        t.nothing


CSV = {
    "regions": "region_id,region_name\n1,N\n",
    "customers": "customer_id,customer_name,region_id\n1,A,1\n",
    "products": 'product_id,product_name,category,price\n10,"P, the first",C,1.00\n',
    "orders": "order_id,customer_id,order_date,is_returned\n1,1,2024-01-01,0\n2,1,2024-01-02,1\n",
}


def write_csv(tmp_path, files: dict[str, str]) -> str:
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True, parents=True)
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_files_with_swapped_and_further_columns(spark, tmp_path):
    lines = {
        "lines/a [1].csv": "order_detail_id,order_id,product_id,quantity\n1,1,10,7\n2,2,10,8\n",
        "lines/b.csv": 'note,quantity,product_id,order_detail_id,order_id\n"x, ""y""",9,10,3,1\n',
        "lines/c.csv": "\ufeffproduct_id,order_id,quantity\n10,2,5\n",
        "lines/empty.csv": "",
        "lines/head.csv": "order_id,product_id,quantity,order_detail_id\n",
    }
    folder = write_csv(tmp_path, {f"{n}/a.csv": text for n, text in CSV.items()} | lines)
    t = load_native(spark, folder, "csv")
    assert sorted(rows(t.lines)) == [(1, 10, 7), (1, 10, 9), (2, 10, 5), (2, 10, 8)]
    assert sorted(k if k else 0 for (k,) in rows(t.line_keys)) == [0, 1, 2, 3]
    found = dict(rows(integrity_report(t)))
    assert found["null lines.order_detail_id"] == 1
    assert sum(found.values()) == 1
    assert rows(t.products)[0][1] == "P, the first"


def test_a_file_without_a_needed_column_is_an_error(spark, tmp_path):
    folder = write_csv(tmp_path, {f"{n}/a.csv": x for n, x in CSV.items()} | {"lines/a.csv": "order_id,quantity\n1,2\n"})
    with pytest.raises(Exception, match="(?i)product_id"):
        load_native(spark, folder, "csv").lines.collect()


@pytest.mark.parametrize("keyed", [True, False])
def test_json_is_read_without_inference(spark, tmp_path, keyed):
    more = ', "order_detail_id": 4' if keyed else ""
    folder = write_csv(tmp_path, {"lines/a.json": f'{{"quantity": 3, "product_id": 2, "order_id": 1{more}, "x": [1]}}\n'})
    before = jobs(spark)
    t = load_native(spark, folder, "json")
    keys, lines = t.line_keys, t.lines
    assert jobs(spark) - before <= 1  # the first line says whether lines have keys
    assert rows(lines) == [(1, 2, 3)]
    assert rows(keys) == [(4,)] if keyed else keys is None


def jobs(spark) -> int:
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def faults(shop):
    return shop(
        regions=(1, 1, 2),
        customers=[(1, 1), (2, 9), (3, 2)],
        products=[(1, "1.00"), (1, "1.00"), (1, "2.00", "other"), (2, None)],
        orders=[(1,), (2, 8), (3, 1, "2024-01-01", None), (4, 3), (4, 3), (4, 3, "2024-02-02")],
        lines=[(1, 1, 1), (7, 1, 1), (7, 1, 1), (7, 6, 1), (2, 5, 1), (None, 1, 1), (1, None, 2)],
    )


def test_violating_rows_add_up_to_the_report(shop, spark):
    t = faults(shop)
    none = spark.createDataFrame([(None, 1, None, None), (None, 1, None, None)], t.orders.schema)
    t._opened["orders"] = t.orders.unionAll(none)
    found = rows(violations(t))
    sums: dict = {}
    for check, _, _, copies in found:
        sums[check] = sums.get(check, 0) + copies
    report = {check: n for check, n in rows(integrity_report(t)) if n}
    assert sums == report and len(report) >= 8
    assert ("orphan lines.order_id", "7", "order_id=7, product_id=1, quantity=1", 2) in found
    assert ("orphan lines.product_id", "5", "order_id=2, product_id=5, quantity=1", 1) in found
    assert ("duplicate orders.order_id", "4", "order_id=4, customer_id=3, order_date=2024-01-01, is_returned=false", 1) in found
    assert ("duplicate orders.order_id", "4", "order_id=4, customer_id=3, order_date=2024-02-02, is_returned=false", 1) in found
    assert ("null orders.order_id", None, "order_id=null, customer_id=1, order_date=null, is_returned=null", 2) in found


def test_sound_and_empty_tables_have_no_violations(shop):
    assert rows(violations(shop(**SHOP))) == []
    assert rows(violations(shop(products=(), customers=(), regions=()))) == []
    hot = shop(orders=[(1,)] * 400 + [(2,)], lines=[(1, 1, 1), (2, 1, 1)])
    assert [(r[0], r[3]) for r in rows(violations(hot))] == [("duplicate orders.order_id", 399)]


def test_line_keys_are_quarantined(shop, spark):
    t = shop(**SHOP)
    t._opened["line_keys"] = spark.createDataFrame([(1,), (1,), (None,), (2,)], "order_detail_id long")
    found = [r for r in rows(violations(t)) if "detail" in r[0]]
    assert found == [
        ("null lines.order_detail_id", None, "order_detail_id=null", 1),
        ("duplicate lines.order_detail_id", "1", "order_detail_id=1", 1),
    ]
