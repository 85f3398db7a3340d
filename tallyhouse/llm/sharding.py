"""Shards of near equal bytes by histogram sort, in DataFrame functions alone.

Rows are ordered by a key: the hash of the text, then a hash of the row. Splitters are found by counting
the exact bytes below candidate key boundaries: each round counts, by the next bits of the key, only the
rows in the key ranges that still hold a splitter. A splitter is done when a boundary lies within the
tolerance of its target, or when one key is left. Then every row knows its shard, and the rows are
exchanged once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm.store import Spool

BITS, STEP = 60, 10
#: A shard may differ from its share by this part of it, where keys allow.
TOLERANCE = 0.002
#: Rows that are numbered in one window; blocks per shard at least.
BLOCK_ROWS, BLOCKS = 1 << 16, 16
#: What a row weighs besides its text.
ROW_BYTES = 8


def _bits(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def measured(docs: DataFrame, text: str, identifier: str, keep: list[str]) -> DataFrame:
    """(doc, size, text_crc32, group, own): bytes, checksum and the two parts of the key of every row."""
    content = F.coalesce(F.col(text), F.lit(""))
    said = F.concat_ws(":", F.coalesce(F.col(identifier).cast("string"), F.lit("null")), F.md5(content))
    return docs.select(
        F.struct(*keep).alias("doc"),
        (F.octet_length(content).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(content).alias("text_crc32"),
        _bits(content).alias("group"),
        _bits(said).alias("own"),
    )


def _counts(rows: DataFrame, ranges: list[tuple]) -> dict[tuple, list]:
    """By key range: bytes, and the least and greatest key, of each bucket of its next bits, in order."""
    number, bucket = F.lit(None), F.lit(None)
    for i, (group, prefix, shift) in enumerate(ranges):
        part = F.col("group") if group is None else F.col("own")
        held = F.shiftright(part, shift) == prefix
        held = held if group is None else held & (F.col("group") == group)
        number = F.when(held, i).otherwise(number)
        bucket = F.when(held, F.shiftright(part, shift - STEP)).otherwise(bucket)
    counted = (
        rows.select(number.cast("int").alias("i"), bucket.cast("long").alias("bucket"), "group", "own", "size")
        .where("i is not null")
        .groupBy("i", "bucket")
        .agg(
            F.sum("size").alias("size"),
            F.min(F.struct("group", "own")).alias("least"),
            F.max(F.struct("group", "own")).alias("most"),
        )
    )
    found: dict[tuple, list] = {r: [] for r in ranges}
    for row in sorted(counted.collect(), key=lambda r: (r["i"], r["bucket"])):
        found[ranges[row["i"]]].append((row["bucket"], row["size"], tuple(row["least"]), tuple(row["most"])))
    return found


def splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """The least keys (group, own) of shards 1 to `shards` - 1, for rows with group, own and size.

    Only counts come to the driver, at most 2 ** STEP for each splitter and round.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / shards
    cuts: dict[int, tuple[int, int]] = {}
    # the key range that holds a splitter, as (whole group or None, leading bits, bits after them), and
    # the bytes below that range
    open_ = {k: ((None, 0, BITS), 0) for k in range(1, shards)} if total else {}
    while open_:
        counts = _counts(rows, sorted({r for r, _ in open_.values()}, key=str))
        after = {}
        for k, ((group, prefix, shift), base) in open_.items():
            aim, under = total * k / shards, base
            for bucket, size, least, most in counts[group, prefix, shift]:
                if under + size >= aim:
                    break
                under += size
            over, left = under + size, shift - STEP
            lower = aim - under < under + size - aim
            if min(aim - under, over - aim) <= slack:
                edge = (bucket if lower else bucket + 1) << left
                cuts[k] = (edge, 0) if group is None else (group, edge)
            elif least == most:
                cuts[k] = least if lower else (least[0], least[1] + 1)
            elif group is None and least[0] == most[0]:
                after[k] = ((least[0], 0, BITS), under)
            else:
                after[k] = ((group, bucket, left), under)
        open_ = after
    return [cuts[k] for k in sorted(cuts)]


def shard(
    docs: DataFrame,
    shards: int = 24,
    text: str = "text",
    identifier: str = "doc_id",
    keep: list[str] | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Shard and place of every row.

    Returns `doc` (a struct of the columns `keep`, by default all), `size` (UTF-8 bytes of the text plus
    8), `text_crc32`, `shard` (0 to `shards` - 1, near equal in bytes) and `slot` (0, 1, ... in the shard).
    Equal texts share a shard, unless a boundary within the tolerance needs their group cut. A null text
    counts as empty. Rows equal in identifier and text have one key and stay together. An empty table
    gives no rows. Sizes and keys are written as a narrow table, which is what the rounds read.

    Slots number the rows of a shard by their own hash: blocks of that hash are counted, and each row is
    its place in its block after the rows of the blocks before, so no task sorts a whole shard.
    """
    spool = Spool(docs.sparkSession, "sharding")
    keep = docs.columns if keep is None else keep
    rows = measured(docs, text, identifier, keep)
    narrow = spool.write(rows if set(keep) <= {identifier} else rows.drop("doc"))
    cuts = splitters(narrow, shards, tolerance)
    bits = math.ceil(math.log2(max(BLOCKS, narrow.count() / shards / BLOCK_ROWS)))
    key = F.struct("group", "own")
    place = F.lit(0)
    if cuts:
        edges = F.array(*[F.struct(F.lit(g).cast("long").alias("group"), F.lit(o).cast("long").alias("own")) for g, o in cuts])
        place = F.size(F.filter(edges, lambda edge: edge <= key))
    placed = lambda df: df.withColumns(
        {"shard": place.cast("int"), "block": F.shiftright("own", BITS - bits)}
    )
    before = W.partitionBy("shard").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = spool.write(
        placed(narrow)
        .groupBy("shard", "block")
        .agg(F.count("*").alias("rows"))
        .select("shard", "block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    )
    inside = W.partitionBy("shard", "block").orderBy("own", "group")
    return (
        placed(narrow if "doc" in narrow.columns else rows)
        .withColumn("number", F.row_number().over(inside))
        .join(starts, ["shard", "block"])
        .withColumn("slot", F.col("start") + F.col("number") - 1)
        .select("doc", "size", "text_crc32", "shard", "slot")
    )


def sharded(docs: DataFrame, shards: int = 24, **options) -> DataFrame:
    """`docs` with `size`, `shard` and `slot`; columns of `docs` with these names are replaced."""
    added = ("size", "shard", "slot")
    placed = shard(docs, shards, **options)
    return placed.select(*[F.col("doc")[c].alias(c) for c in docs.columns if c not in added], *added)
