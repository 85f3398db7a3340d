"""Exact global windows (O22) without a task that holds the whole input.

A window without a partition, or with a huge one, sorts all its rows in a single
task. Here equal values collapse first (a map-side combine, so one value may
hold any part of the rows), and running totals over the distinct values are
built from blocks of neighbouring values:

    key                    one row per distinct value
    key >> 20              sums per block of 2^20 neighbouring values

The window over the values is partitioned by block, the one over the blocks has
no partition, and adding both gives the running total. Their sizes are bounded
by arithmetic, not by the data:

* a block holds at most 2^20 whole numbers;
* LONG values with a sum of sizes below 2^63 fill fewer than 2^23 blocks: at most
  2^22 blocks lie between -2^41 and 2^41, and fewer than 2^22 values can be larger.
  Ordinary amounts fill some dozens.

For keys without such a sum, such as ids, ``levels`` repeats the step on the
blocks. Amounts beyond 64 bits (DECIMAL(38,0), below 10^30) are cut into two LONG
limbs, the lower one of 12 digits: totals per high limb, with blocks of their own, are
added to those within it. A low limb fills at most 2^20 blocks, and as a sum of 10^30
holds no more than 1.5 million different blocks of high limbs, no window sees more.

A null value is lower than every known one, also below negative ones: its order key
is ``lowest`` and it adds nothing to a total. Block numbers depend on the value
alone, so a task that runs again after a lost executor gives the same rows. Nothing
is sampled and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tallyhouse.functions.numbers import WHOLE

BLOCK_BITS = 20
#: Digits of the lower limb of a wide key.
LIMB = 12
#: Order keys of null: no amount of this type is as low.
LOWEST_LONG, LOWEST_WHOLE = -(2**63 - 1), -(10**30)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def prefix_totals(
    frame: DataFrame,
    key: str,
    measures: Sequence[str],
    within: Sequence[str] = (),
    bits: int = BLOCK_BITS,
    levels: int = 1,
    high: str | None = None,
) -> DataFrame:
    """Add ``before_<m>``: the sum of m over the rows with a smaller key.

    ``key`` is a non-null LONG, unique within the (non-null) ``within`` columns,
    and ``measures`` are not null. With ``high``, another LONG column, rows are ordered
    by it first and by ``key`` within it.
    """
    parts = [*within, high] if high else list(within)
    if levels == 0 and high is None:
        return _running(frame, key, measures, within)

    if levels == 0:
        marked, block = frame, high
        above = lambda sums: prefix_totals(sums, high, measures, within, bits)
    else:
        parts.append(block := f"_block{levels}{high or ''}")
        marked = frame.withColumn(block, F.shiftright(key, bits))
        above = lambda sums: prefix_totals(sums, block, measures, within, bits, levels - 1, high)
    blocks = marked.groupBy(*parts).agg(*[F.sum(m).alias(m) for m in measures])
    offsets = above(blocks).select(
        *parts, *[F.col(f"before_{m}").alias(f"_offset_{m}") for m in measures]
    )
    local = _running(marked, key, measures, parts)
    return local.join(offsets, parts).select(
        *frame.columns,
        *[(F.col(f"before_{m}") + F.col(f"_offset_{m}")).alias(f"before_{m}") for m in measures],
    )


def _running(
    frame: DataFrame, key: str, measures: Sequence[str], within: Sequence[str]
) -> DataFrame:
    earlier = (
        Window.partitionBy(*within).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    )
    zero = F.lit(0).cast("long")
    return frame.select(
        "*", *[F.coalesce(F.sum(m).over(earlier), zero).alias(f"before_{m}") for m in measures]
    )


def is_wide(frame: DataFrame, value: str) -> bool:
    """Whether amounts of a column may go beyond 64 bits."""
    return isinstance(frame.schema[value].dataType, DecimalType)


def lowest(wide: bool) -> Column:
    """The order key of null."""
    return F.lit(str(LOWEST_WHOLE)).cast(WHOLE) if wide else F.lit(LOWEST_LONG).cast("long")


def with_order_key(frame: DataFrame, value: str, key: str = "_key") -> DataFrame:
    """Add the order key of a value: the value itself as LONG or DECIMAL(38,0), null as the lowest.

    A column that cannot be null also spares the filter Spark would push into one
    branch of a self-join, which would keep the branches from sharing a shuffle.
    """
    wide = is_wide(frame, value)
    return frame.withColumn(
        key, F.coalesce(F.col(value).cast(WHOLE if wide else "long"), lowest(wide))
    )


def value_groups(frame: DataFrame, key: str, within: Sequence[str] = ()) -> DataFrame:
    """One row per distinct order key and group.

    Adds ``rows``, ``total`` = value x rows (0 for null) and ``steps`` = 1.
    """
    wide = is_wide(frame, key)
    value = F.col(key) if wide else F.col(key).cast("decimal(19,0)")
    known = F.when(F.col(key) == lowest(wide), F.lit(0)).otherwise(
        (value * F.col("rows").cast("decimal(18,0)")).cast(WHOLE)
    )
    return (
        frame.groupBy(*within, key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("*", known.cast(WHOLE).alias("total"), F.lit(1).cast("long").alias("steps"))
    )


def climb(
    groups: DataFrame, key: str, within: Sequence[str] = (), descending: bool = True
) -> DataFrame:
    """Add ``before_rows``, ``before_total`` and ``before_steps`` to value groups.

    These sum what comes earlier in value order. So rank is before_rows + 1, dense
    rank before_steps + 1, and a running sum in which ties share a value is
    before_total + total.
    """
    measures, wide = ("rows", "total", "steps"), is_wide(groups, key)
    # a decimal is subtracted from 0, as its negation keeps 34 digits only
    order = (F.lit(0).cast(WHOLE) - F.col(key) if wide else -F.col(key)) if descending else F.col(key)
    if not wide:
        ordered = groups.withColumn("_order", order)
        return prefix_totals(ordered, "_order", measures, within).drop("_order")
    limb = F.lit(10**LIMB).cast("decimal(13,0)")
    low = F.pmod(order, limb)
    cut = groups.withColumns(
        {"_low": low.cast("long"), "_high": _div(order - low.cast(WHOLE), limb).cast("long")}
    )
    return prefix_totals(cut, "_low", measures, within, high="_high").drop("_low", "_high")


def with_dense_rank(
    frame: DataFrame,
    value: str,
    rank: str,
    within: Sequence[str] = (),
    descending: bool = True,
    counts: bool = False,
) -> DataFrame:
    """Add the dense rank of every row by value, over all rows or within groups.

    A null value is lower than every other and stays null. ``counts`` says that the
    values, over all rows, count disjoint parts of one table: d different counts add up
    to d * d / 2 at least, so a table of 10^12 rows has at most 1.5 million of them. Their
    ranks are broadcast then, and the rows are not shuffled by a key of few values.
    """
    keyed = with_order_key(frame, value)
    ranks = climb(value_groups(keyed, "_key", within), "_key", within, descending).select(
        *within, "_key", (F.col("before_steps") + 1).alias(rank)
    )
    if counts and not within:
        ranks = F.broadcast(ranks)
    return keyed.join(ranks, [*within, "_key"]).drop("_key")


def with_tile(
    frame: DataFrame, value: str, tiebreak: str, tiles: int, descending: bool = True
) -> DataFrame:
    """Add the global ``position`` (row number) and ``tile`` (n-tile) by value.

    Equal values are numbered by ascending tiebreak, a unique LONG.
    """
    keyed = with_order_key(with_order_key(frame, value), tiebreak, "_id")
    groups = value_groups(keyed, "_key")
    before = climb(groups, "_key", (), descending).select("_key", "before_rows")
    numbered = prefix_totals(
        keyed.withColumn("_one", F.lit(1).cast("long")), "_id", ("_one",), ("_key",), levels=2
    )
    position = F.col("before_rows") + F.col("before__one") + 1
    return (
        numbered.join(before, "_key")
        .select(*frame.columns, position.alias("position"), count_of(groups).alias("_n"))
        .withColumn("tile", tile_of(F.col("position"), F.col("_n"), tiles))
        .drop("_n")
    )


def count_of(groups: DataFrame) -> Column:
    """The number of grouped rows as a scalar subquery over the same shuffle."""
    return groups.agg(F.sum("rows")).scalar()


def tile_of(position: Column, rows: Column, tiles: int) -> Column:
    """The n-tile of a 1-based row position: larger tiles first, as ntile deals them."""
    size, extra = _div(rows, F.lit(tiles)), rows % tiles
    in_larger = extra * (size + 1)
    return F.when(
        position <= in_larger, _div(position - 1, size + 1) + 1
    ).otherwise(extra + _div(position - in_larger - 1, F.nullif(size, F.lit(0).cast("long"))) + 1)


def tile_sums(frame: DataFrame, value: str, tiles: int) -> DataFrame:
    """Rows and total value of each n-tile by descending value: tile, rows, total.

    Equal values are interchangeable in a sum, so the result needs no tie-break: a
    run of equal values is cut where a tile ends.
    """
    groups = value_groups(with_order_key(frame, value), "_key")
    wide = is_wide(groups, "_key")
    placed = climb(groups, "_key").select(
        F.when(F.col("_key") == lowest(wide), F.lit(0)).otherwise(F.col("_key")).cast(WHOLE).alias("_each"),
        (F.col("before_rows") + 1).alias("first"),
        (F.col("before_rows") + F.col("rows")).alias("last"),
        count_of(groups).alias("n"),
    )
    size, extra = _div(F.col("n"), F.lit(tiles)), F.col("n") % tiles
    tile = F.col("tile")
    starts = (tile - 1) * size + F.least(tile - 1, extra) + 1
    ends = tile * size + F.least(tile, extra)
    cut = placed.select(
        "*",
        F.explode(
            F.sequence(
                tile_of(F.col("first"), F.col("n"), tiles),
                tile_of(F.col("last"), F.col("n"), tiles),
            )
        ).alias("tile"),
    ).withColumn(
        "rows", F.least(F.col("last"), ends) - F.greatest(F.col("first"), starts) + 1
    )
    return cut.groupBy("tile").agg(
        F.sum("rows").alias("rows"),
        F.sum((F.col("_each") * F.col("rows").cast("decimal(18,0)")).cast(WHOLE)).alias("total"),
    )
