"""Connected components of a graph whose links are spread over executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.store import Spool


def _smallest(links: DataFrame, spool: Spool) -> tuple[DataFrame, DataFrame]:
    """Each link (a, b) with the smallest b of its a.

    The minimum is combined before the shuffle and written, so the join back reads two plain
    exchanges and a node with very many links can be split over tasks.
    """
    least = spool.write(links.groupBy("a").agg(F.min("b").alias("m")))
    return links.join(least, "a"), least


def components(links: DataFrame, spool: Spool) -> DataFrame:
    """(node, root) for every node of `links(a, b)`; root is the smallest node of the component.

    Alternating large-star and small-star steps: each replaces links by links to the smallest
    neighbour, which keeps components and ends, after a number of rounds logarithmic in the longest
    path, in stars around the smallest nodes. Nothing is collected but a count and a checksum.
    """
    links = spool.write(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        joined, least = _smallest(both, spool)
        large = spool.write(
            joined.where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .distinct()
        )
        spool.drop(links, least)
        joined, least = _smallest(large, spool)
        small = joined.select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
        )).alias("link")).select("link.a", "link.b").where(F.col("a") != F.col("b"))
        links = spool.write(small.distinct())
        spool.drop(large, least)
        now = links.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
        ).first()
        if now == state:
            break
        state = now
    ends = links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(ends)
