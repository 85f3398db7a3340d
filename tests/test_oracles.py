"""Every report against its DuckDB statement, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tallyhouse.oracles import ORACLES
from tallyhouse.plans import PLANS

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "decimal(28,2)": "DECIMAL(28,2)",
}

needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("region", "nation", "customer", "part", "orders", "lineitem"):
        connection.sql(f"CREATE VIEW {table} AS FROM '{FOLDER}/{table}.parquet'")
    return connection


def in_order(table):
    return sorted(table, key=lambda row: [(v is None, 0 if v is None else v) for v in row])


@needs_data
@pytest.mark.parametrize("name", sorted(PLANS))
def test_same_rows_and_types(spark, duck, name):
    frame = queries()[name](spark, FOLDER)
    expected = duck.sql(oracle_sql()[name])
    columns = sorted(frame.columns)
    assert columns == sorted(expected.columns)

    kinds = {f.name: TYPES[f.dataType.simpleString()] for f in frame.schema}
    assert kinds == dict(zip(expected.columns, map(str, expected.types)))

    places = [expected.columns.index(c) for c in columns]
    ours = in_order(tuple(row[c] for c in columns) for row in frame.collect())
    theirs = in_order(tuple(row[i] for i in places) for row in expected.fetchall())
    assert ours == theirs


def test_every_report_has_an_oracle():
    assert set(PLANS) == set(ORACLES)
    assert set(PLANS) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_all_81_statements_are_there():
    numbers = {name.split("_")[0] + "_" + name.split("_")[1] for name in PLANS if name[0] == "q"}
    expected = {
        "q01": ["01", "02", "03", "04a", "04b", "05", "06", "07", "08", "09a", "09b", "09c", "10",
                "11a", "11b"],
        "q02": ["01a", "01b", "01c", "02", "03", "04", "05", "06", "07", "08", "09"],
        "q03": ["01", "02a", "02b", "03", "04", "05", "06a", "06b", "06c", "07", "08", "09", "10"],
        "q04": ["01a", "01b", "02", "03", "04", "05"],
        "q05": ["01", "02", "03", "04", "05a", "05b"],
        "q06": ["01", "02a", "02b", "03", "04", "05", "06"],
        "q08": ["01", "02", "05"],
        "q09": ["01", "02", "03", "04", "05"],
        "q10": ["01", "02", "03", "04", "05"],
        "q11": ["01", "02", "03", "04", "05"],
        "q12": ["01", "02", "03", "04", "05"],
    }
    wanted = {f"{part}_{number}" for part, listed in expected.items() for number in listed}
    assert len(wanted) == 81
    assert numbers == wanted


@needs_data
def test_entry_is_lazy_and_has_rows(spark):
    frame = entry(spark)
    assert frame.columns == ["year", "month", "revenue"]
    assert frame.count() > 0
