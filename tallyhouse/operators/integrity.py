"""Key, reference and null checks of the logical tables (O2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.sources.tables import Tables

#: Table, its key, and the table and column that refer to it.
LINKS = (
    ("regions", "region_id", "customers"),
    ("customers", "customer_id", "orders"),
    ("products", "product_id", "lines"),
    ("orders", "order_id", "lines"),
)


def _counted(frame: DataFrame, key: str, name: str, **more: Column) -> DataFrame:
    """Rows per key as ``name``, and further sums."""
    one = F.count(F.lit(1)).alias(name)
    return frame.groupBy(key).agg(one, *[F.sum(c).alias(n) for n, c in more.items()])


def _as_rows(frame: DataFrame, found: dict[str, Column]) -> DataFrame:
    """check, violations: one row for each sum over the frame, 0 for none."""
    sums = [
        F.struct(F.lit(check).alias("check"), F.coalesce(F.sum(n), F.lit(0).cast("long")).alias("violations"))
        for check, n in found.items()
    ]
    return frame.agg(F.array(*sums).alias("_rows")).select(F.inline("_rows"))


def integrity_report(tables: Tables) -> DataFrame:
    """check, violations: one row per rule, 0 where the rule holds.

    Null keys count rows without a key; they are no duplicates. Duplicates count
    surplus rows, orphans count referring rows; a null reference is no orphan. Lines
    have a key of their own, ``order_detail_id``, only in layouts that hold one.

    Both sides of a reference are counted per key before they meet in one outer join,
    which answers every rule about that key: a key with many rows is one row there.
    """
    checks = []
    for table, key, referring in LINKS:
        extra = {"unflagged": F.col("is_returned").isNull().cast("long")} if table == "orders" else {}
        own = _counted(getattr(tables, table), key, "own", **extra)
        others = _counted(getattr(tables, referring), key, "others")
        own_rows, known = F.col("own"), F.col(key).isNotNull()
        found = {
            f"null {table}.{key}": F.when(~known, own_rows),
            f"duplicate {table}.{key}": F.when(known, own_rows - 1),
            f"orphan {referring}.{key}": F.when(known & own_rows.isNull(), F.col("others")),
        }
        if table == "orders":
            found["orders without lines"] = F.when(F.col("others").isNull(), own_rows)
            found["orders without return flag"] = F.col("unflagged")
        checks.append(_as_rows(own.join(others, key, "full"), found))
    lines = tables.line_keys
    if lines is not None:
        key, own_rows = "order_detail_id", F.col("own")
        known = F.col(key).isNotNull()
        checks.append(
            _as_rows(
                _counted(lines, key, "own"),
                {
                    f"null lines.{key}": F.when(~known, own_rows),
                    f"duplicate lines.{key}": F.when(known, own_rows - 1),
                },
            )
        )
    return reduce(DataFrame.unionAll, checks)


def _told(frame: DataFrame, check: str, key: str) -> DataFrame:
    """check, key, row: the rows of a frame as text, and the value of their key."""
    said = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in frame.columns]
    return frame.select(
        F.lit(check).alias("check"), F.col(key).cast("string").alias("key"), F.concat_ws(", ", *said).alias("row")
    )


def _surplus(frame: DataFrame, check: str, key: str) -> DataFrame:
    """All rows of a key with several rows but its first in column order, with their copies.

    Keys are counted first, so only rows of such keys move. Equal rows are one row with a
    number of copies, and the row that stays is a minimum: neither needs a sort of the key.
    """
    several = frame.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col(key).isNotNull() & (F.col("_n") > 1))
    found = frame.join(several.select(key), key, "left_semi").select(*frame.columns)
    rows = _told(found, check, key).groupBy("check", "key", "row").agg(F.count(F.lit(1)).alias("copies"))
    kept = rows.groupBy("key").agg(F.min("row").alias("_kept"))
    left = F.when(F.col("row") == F.col("_kept"), F.col("copies") - 1).otherwise(F.col("copies"))
    return rows.join(kept, "key").select("check", "key", "row", left.alias("copies")).where("copies > 0")


def violations(tables: Tables) -> DataFrame:
    """check, key, row, copies: the rows that break a rule of ``integrity_report``.

    The copies of a rule add up to the report's number. Of rows with one key the first in
    text order stays and the others are surplus. A row that breaks several rules is there
    for each of them. Sound tables give no rows.
    """

    def one_each(frame: DataFrame, check: str, key: str) -> DataFrame:
        return _told(frame, check, key).groupBy("check", "key", "row").agg(F.count(F.lit(1)).alias("copies"))

    found = []
    for table, key, referring in LINKS:
        own, others = getattr(tables, table), getattr(tables, referring)
        keys = own.select(key)
        found += [
            one_each(own.where(F.col(key).isNull()), f"null {table}.{key}", key),
            _surplus(own, f"duplicate {table}.{key}", key),
            one_each(
                others.where(F.col(key).isNotNull()).join(keys, key, "left_anti").select(*others.columns),
                f"orphan {referring}.{key}", key,
            ),
        ]
        if table == "orders":
            bare = own.join(others.select(key), key, "left_anti").select(*own.columns)
            found.append(one_each(bare, "orders without lines", key))
            found.append(one_each(own.where(F.col("is_returned").isNull()), "orders without return flag", key))
    lines, key = tables.line_keys, "order_detail_id"
    if lines is not None:
        found.append(one_each(lines.where(F.col(key).isNull()), f"null lines.{key}", key))
        found.append(_surplus(lines, f"duplicate lines.{key}", key))
    return reduce(DataFrame.unionAll, found)
