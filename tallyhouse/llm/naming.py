"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes. The distinct blocks of the corpus are sorted
into integer names; then adjacent names are paired, the distinct pairs are sorted into new names, and so
on until one name is left of each text. Two texts are equal exactly if they have the same number of blocks
and the same last name.

The content of a block is shuffled once, in an aggregate that combines copies before the shuffle. After
it, blocks go by their MD5: the aggregate counts the distinct contents of every digest, and should two
contents share one, blocks go by their content instead. So a digest never decides that texts are equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.store import Spool

BLOCK_BYTES = 4096


def _blocks(text: Column, size: int) -> Column:
    """The blocks of a text in order; an empty text is one empty block."""
    data = text.cast("binary")
    last = F.greatest(F.ceil(F.octet_length(text) / size).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def _digest(block: Column) -> Column:
    return F.unhex(F.md5(block))


def _named(distinct: DataFrame, keys: list[str], spool: Spool) -> DataFrame:
    """`distinct` rows sorted by `keys`, with increasing integer names."""
    return spool.write(
        distinct.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(*keys, F.monotonically_increasing_id().alias("name"))
    )


def block_names(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
    digest: Callable[[Column], Column] = _digest,
) -> DataFrame:
    """The identity of the text of every row of `docs`.

    Returns `doc` (a struct of the columns `keep`, by default all), `row` (a number of the row),
    `text_sha256`, `blocks` (how many the text has) and `name`; texts are identical, byte by byte, exactly
    if `blocks` and `name` agree. A null text counts as empty. Repeated rows are rows of their own.
    """
    spool = Spool(docs.sparkSession, "naming")
    keep = docs.columns if keep is None else keep
    content = F.coalesce(F.col(text), F.lit(""))
    cut = docs.select(F.explode(_blocks(content, block_bytes)).alias("block"))
    distinct = cut.distinct().withColumn("key", digest(F.col("block")))
    names = _named(distinct, ["key"], spool)
    key = digest
    if not names.groupBy("key").count().where("count > 1").isEmpty():
        spool.drop(names)
        names = _named(cut.distinct().withColumnRenamed("block", "key"), ["key"], spool)
        key = lambda block: block

    rows = spool.write(
        docs.select(
            F.struct(*keep).alias("doc"),
            F.monotonically_increasing_id().alias("row"),
            F.unhex(F.sha2(content, 256)).alias("sha256"),
            F.transform(_blocks(content, block_bytes), key).alias("keys"),
        )
    )
    units = spool.write(
        rows.select("row", F.size("keys").alias("n"), F.posexplode("keys").alias("pos", "key"))
        .join(names, "key")
        .select("row", "n", "pos", "name")
    )
    longest = rows.agg(F.max(F.size("keys"))).first()[0] or 0
    spool.drop(names)

    # a text of n blocks is done once ceil(log2(n)) levels have halved it to one unit
    done, width = [units.where("n = 1").select("row", "name")], 1
    while width < longest:
        pairs = spool.write(
            units.where(F.col("n") > width)
            .groupBy("row", "n", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
            )
        )
        names = _named(pairs.select("left", "right").distinct(), ["left", "right"], spool)
        units = spool.write(pairs.join(names, ["left", "right"]).select("row", "n", "pos", "name"))
        spool.drop(pairs, names)
        done.append(units.where((F.col("n") > width) & (F.col("n") <= 2 * width)).select("row", "name"))
        width *= 2

    last = done[0]
    for level in done[1:]:
        last = last.unionByName(level)
    return spool.write(
        rows.join(last, "row").select(
            "doc", "row", F.lower(F.hex("sha256")).alias("text_sha256"), F.size("keys").alias("blocks"), "name"
        )
    )


def exact_duplicates(
    docs: DataFrame, text: str = "text", identifier: str = "doc_id", keep: list[str] | None = None, **options
) -> DataFrame:
    """The rows of block_names with `keep_id`, `group_size` and `kept`.

    Of equal texts the row with the largest identifier stays (null is smaller than any); of several such
    rows, the last. The groups are written, so a text that very many rows share can be split over tasks.
    """
    named = block_names(docs, text, keep, **options)
    spool = Spool(docs.sparkSession, "duplicates")
    value = F.col("doc")[identifier].alias("id")
    groups = spool.write(
        named.groupBy("blocks", "name").agg(
            F.max(F.struct(value, "row")).alias("last"), F.count("*").alias("group_size")
        )
    )
    return (
        named.join(groups, ["blocks", "name"])
        .withColumns({"keep_id": F.col("last.id"), "kept": F.col("row") == F.col("last.row")})
        .drop("last")
    )
