"""From raw documents to sharded training text, in stages that are written and read again.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
`docs`, whatever they are. Nulls, repeated rows and empty tables are defined by the operators in
`tallyhouse.llm`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import decontaminate, mixing, sharding, simhash, toxicity
from tallyhouse.llm.store import Spool, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; learnt from `docs` and the labels of the folder."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints: shingles of 3 words, links at 3 bits."""
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=3)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of 10 words of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them; those taken twice are there twice."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their size in bytes, shard (0 to 23) and slot."""
    return sharding.sharded(docs, 24)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("mixing", mix_sources),
    ("sharding", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet in the shared folder and read again."""
    spool, docs = Spool(spark, "pipeline"), table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        before, docs = docs, spool.write(stage(spark, docs, sf_dir))
        if id(before) in spool.paths:
            spool.drop(before)
    return docs


#: Learnt scores and fingerprints have no SQL; tests/llm compares the stages with plain Python.
ORACLE_SQL = None
