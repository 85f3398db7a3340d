from __future__ import annotations

import os
import sys
from datetime import date
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tallyhouse.sources.tables import NATIVE, from_frames  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def shop(spark):
    """Build tables from short rows; what a test leaves out gets one plain row.

    orders: (order, customer, day, returned); lines: (order, product, quantity);
    products: (product, price[, name[, category]]); customers: (customer, region).
    """

    def build(orders=(), lines=(), products=((1, "10.00"),), customers=((1, 1),), regions=(1,)):
        def product(key, price, name=None, category="A"):
            return (key, name or f"p{key}", category, None if price is None else Decimal(price))

        def order(key, customer=1, day="2024-01-01", returned=False):
            return (key, customer, date.fromisoformat(day), returned)

        rows = {
            "regions": [(r, f"r{r}") for r in regions],
            "customers": [(c, f"c{c}", r) for c, r in customers],
            "products": [product(*p) for p in products],
            "orders": [order(*o) for o in orders],
            "lines": list(lines),
        }
        frames = {
            name: spark.createDataFrame(rows[name], schema).coalesce(1)
            for name, schema in NATIVE.items()
        }
        return from_frames(**frames)

    return build


def rows(frame):
    return [tuple(row) for row in frame.collect()]


def final_plan(frame) -> str:
    """The text of the plan that ran."""
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()
