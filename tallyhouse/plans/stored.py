"""Tables that are checked, and written and read again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.numbers import WHOLE, cents
from tallyhouse.operators.integrity import integrity_report, violations
from tallyhouse.plans.registry import plan
from tallyhouse.plans.sales import revenue_by_month
from tallyhouse.plans.trends import last_year_by_month
from tallyhouse.sources.ingest import new_folder, write_native
from tallyhouse.sources.layout import load_layout, write_layout
from tallyhouse.sources.rollups import with_rollups, write_rollups
from tallyhouse.sources.tables import NATIVE, Tables, load_native


@plan("check_integrity")
def check_integrity(t: Tables) -> DataFrame:
    return integrity_report(t)


@plan("check_violations")
def check_violations(t: Tables) -> DataFrame:
    """The rows behind the numbers of the integrity report."""
    return violations(t)


def _number(column: str, kind: T.DataType) -> Column:
    """A whole number that depends on a value: cents, days, 0 or 1, or the length of a text."""
    value = F.col(column)
    if isinstance(kind, T.StringType):
        return F.length(value)
    if isinstance(kind, T.DecimalType):
        return cents(value)
    if isinstance(kind, T.DateType):
        return F.unix_date(value)
    return value.cast("long")


@plan("ingest_tables")
def ingest_tables(t: Tables) -> DataFrame:
    """Writes the five tables, reads them back, and sums what each column holds."""
    folder = new_folder(t.orders.sparkSession)
    write_native(t, folder)
    again = load_native(t.orders.sparkSession, folder)
    sums = []
    for name, schema in NATIVE.items():
        held = [
            F.struct(
                F.lit(f"{name}.{f.name}").alias("column_name"),
                F.count(f.name).alias("filled"),
                F.coalesce(F.sum(_number(f.name, f.dataType).cast(WHOLE)), F.lit(0)).cast("long").alias("total"),
            )
            for f in schema
        ]
        sums.append(getattr(again, name).agg(F.array(*held).alias("_held")).select(F.inline("_held")))
    return reduce(DataFrame.unionAll, sums)


@plan("ingest_by_month")
def ingest_by_month(t: Tables) -> DataFrame:
    """Writes the layout by month and order, and reports the last year from it."""
    folder = new_folder(t.orders.sparkSession)
    write_layout(t, folder, buckets=8)
    return last_year_by_month(load_layout(t.orders.sparkSession, folder))


@plan("ingest_rollups")
def ingest_rollups(t: Tables) -> DataFrame:
    """Writes the stored sums, and reports revenue by month from them."""
    folder = new_folder(t.orders.sparkSession)
    write_rollups(t, folder)
    return revenue_by_month(with_rollups(t, folder))
