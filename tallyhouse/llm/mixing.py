"""Mixing sources to target weights by hash thresholds.

Each row has a hash. A source whose target is f whole passes and a rest takes all its rows f times and,
once more, the rows whose hash lies below a threshold. The threshold is found without sorting rows: sizes
are summed by source and leading bits of the hash, the bucket in which the running sum crosses the rest is
refined by the next bits, and only the rows of that bucket are read again. Thresholds are nested: a larger
target of the same source keeps every row that a smaller one keeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm.store import Spool

#: Words are runs without ASCII white space.
WORDS = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order of their names, repeated.
WEIGHTS = (5, 2, 1)
#: Size of the mix as a part of all sizes, and the most passes over a source.
SHARE, PASSES = 1.5, 2
#: Bits of the hash in all, and in each histogram.
BITS, STEP = 60, 10
#: Sources up to this number have their thresholds broadcast; beyond it, the join is a shuffle.
FEW_SOURCES = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def row_hash(identifier: Column, text: Column) -> Column:
    """60 bits that depend on the identifier and the text alone, so reruns agree."""
    said = F.concat(
        F.coalesce(identifier.cast("string"), F.lit("null")),
        F.lit(":"),
        F.coalesce(F.md5(text), F.lit("null")),
    )
    return F.conv(F.substring(F.md5(said), 1, BITS // 4), 16, 10).cast("long")


def targets(
    sources: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, have the weights in turn. They share `share` times all sizes by
    weight; a target stops at `passes` times its source's size and the excess goes to the others by weight
    until none is above. With sources ordered by size per weight, the first ones stop: source k is the first
    that does not if what the sources before it leave, shared by the weights from k on, fits into it.
    The windows without a partition see one row per source.
    """
    ratio = F.col("room") / F.col("weight")
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    by_ratio = W.orderBy(ratio.asc(), F.col("place"))
    stopped = F.coalesce(F.sum("room").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    going = F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    part = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") - 1) % len(weights) + 1)
    return (
        sources.withColumn("place", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("weight", part)
        .withColumn("room", passes * F.col("source_size"))
        .withColumn("budget", share * F.sum("source_size").over(everything))
        .withColumn("level", (F.col("budget") - stopped) / going)
        .withColumn("fits", F.when(F.col("level") <= ratio, F.struct(ratio, "place", "level")))
        .withColumn("level", F.min("fits").over(everything)["level"])
        .withColumn("target", F.least(F.col("weight") * F.col("level"), F.col("room").cast("double")))
        .select("source", "source_size", "target")
    )


def _with_sources(rows: DataFrame, sources: DataFrame, count: int) -> DataFrame:
    """Join on the source, null matching null; `rows` are not shuffled while the sources are few."""
    side = sources.withColumnRenamed("source", "_source")
    side = F.broadcast(side) if count <= FEW_SOURCES else side
    return rows.join(side, rows["source"].eqNullSafe(side["_source"])).drop("_source")


def thresholds(measured: DataFrame, spool: Spool, **options) -> tuple[DataFrame, int]:
    """(source, source_size, target, whole, below) for `measured(source, size, hash)`, and their number.

    A row of the source is taken `whole` times, and once more if its hash is smaller than `below`: the
    rows below come nearest to the rest of the target, by less than the size of the rows at the boundary.
    """
    sums = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    state = spool.write(
        targets(sums, **options)
        .withColumn("whole", F.floor(F.try_divide("target", "source_size")))
        .withColumn("whole", F.coalesce("whole", F.lit(1)).cast("int"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("prefix", F.lit(0).cast("long"))
        .withColumn("base", F.lit(0).cast("long"))
        .withColumn("below", F.when(F.col("rest") <= 0, F.lit(0)).cast("long"))
    )
    count = state.count()
    columns = state.columns
    by_digit = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    shift = BITS
    while shift and not state.where("below is null").isEmpty():
        open_ = state.where("below is null").select("source", "prefix", "base", "rest")
        inside = _with_sources(measured, open_, count).where(F.shiftright("hash", shift) == F.col("prefix"))
        shift -= STEP
        buckets = inside.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(
            F.sum("size").alias("size"),
            F.min("hash").alias("least"),
            F.max("hash").alias("most"),
            F.max("base").alias("base_"),
            F.max("rest").alias("rest_"),
        )
        crossed = (
            buckets.withColumn("upto", F.col("base_") + F.sum("size").over(by_digit))
            .where(F.col("upto") >= F.col("rest_"))
            .groupBy(F.col("source").alias("_source"))
            .agg(F.min(F.struct("bucket", "upto", "size", "least", "most")).alias("at"))
        )
        under = F.col("at.upto") - F.col("at.size")
        # one hash left: it goes to the side that comes nearer
        cut = F.col("at.least") + (F.col("at.upto") - F.col("rest") <= F.col("rest") - under).cast("long")
        single = F.col("at.least") == F.col("at.most")
        after = spool.write(
            state.join(crossed, state["source"].eqNullSafe(crossed["_source"]), "left")
            .withColumn("below", F.coalesce("below", F.when(single, cut)))
            .withColumn("prefix", F.coalesce("at.bucket", "prefix"))
            .withColumn("base", F.coalesce(under, "base"))
            .select(*columns)
        )
        spool.drop(state)
        state = after
    return state.select("source", "source_size", "target", "whole", "below"), count


def measured_rows(docs: DataFrame, text: str, source: str, identifier: str) -> DataFrame:
    """`docs` as (doc, source, size, hash): the row as a struct, its source, words and hash."""
    return docs.select(
        F.struct(*docs.columns).alias("doc"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        row_hash(F.col(identifier), F.col(text)).alias("hash"),
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    identifier: str = "doc_id",
    keep: list[str] | None = None,
    **options,
) -> DataFrame:
    """What a mix of the sources takes of every row.

    Returns `doc` (a struct of the columns `keep`, by default all), `size` (words; null text 0), `source`,
    `source_size`, `target`, `copies` (how often the mix repeats the row) and `taken` (size times copies).
    Null is a source of its own. Rows that are equal in identifier and text have one hash and are taken
    together. A source without words has target 0 and its rows are taken once. No row is taken more than
    `passes` times. Sizes and hashes are written as a narrow table, which is what the refinement reads.
    """
    spool = Spool(docs.sparkSession, "mixing")
    keep = docs.columns if keep is None else keep
    rows = measured_rows(docs, text, source, identifier).select(
        F.struct(*[F.col("doc")[c].alias(c) for c in keep]).alias("doc"), "source", "size", "hash"
    )
    narrow = spool.write(rows if set(keep) <= {identifier, source} else rows.drop("doc"))
    cuts, count = thresholds(narrow, spool, **options)
    copies = F.col("whole") + F.coalesce(F.col("hash") < F.col("below"), F.lit(False)).cast("int")
    return (
        _with_sources(narrow if "doc" in narrow.columns else rows, cuts, count)
        .withColumn("copies", copies)
        .withColumn("taken", F.col("size") * F.col("copies"))
        .select("doc", "size", "source", "source_size", "target", "copies", "taken")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """`docs` as the mix takes them: rows left out are gone, rows taken twice are there twice."""
    return mix(docs, **options).select("doc", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("doc.*")
