"""The token cache with repeated digests, and ranks against the tokenizer."""

from __future__ import annotations

import public_tokenizers as files
import pytest
from tokenizers import Tokenizer

from tallyhouse.llm import tokens
from tallyhouse.llm.store import new_folder

FILE = files.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, digest string, n_tokens int"
TEXTS = [
    None, "", " ", "a plain text", "a plain text", "<|endoftext|>", "x<|endoftext|> y <|endoftext|>", "<|endoftext|", "\n\n  \t",
    "na\u00efve \U0001f600 \u65e5\u672c\u8a9e I'll we've 12345 \u00bd \u2028", "z" * 30_000, "many words " * 20_000, "\0\x7f", " '' 's",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(k, x, "clash", 7) for k, x in enumerate(TEXTS)], SCHEMA)


@pytest.fixture(scope="module")
def expected():
    model = Tokenizer.from_file(FILE)
    return {k: (len((x or "").encode()), len(model.encode(x or "", add_special_tokens=False).ids)) for k, x in enumerate(TEXTS)}


@pytest.fixture(scope="module")
def ranks():
    return tokens.Ranks(files.path("byte_bpe_50k.tiktoken"), FILE, files.PATTERN)


def counted(docs, cache, ranks=None):
    rows = tokens.count_tokens(docs, FILE, cache, ranks=ranks).collect()
    assert len(rows) == docs.count()
    return {r["doc"]["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in rows}


def test_ranks_and_tokenizer_count_alike(spark, docs, expected, ranks):
    assert counted(docs, new_folder(spark, "cache")) == expected
    assert counted(docs, new_folder(spark, "cache"), ranks) == expected


def test_a_digest_twice_in_the_cache_counts_once(spark, docs, expected):
    cache = new_folder(spark, "cache")
    half = docs.where("doc_id % 2 = 0")
    counted(half, cache)
    again = spark.read.parquet(cache).collect()
    spark.createDataFrame(again, tokens.CACHE).write.mode("append").parquet(cache)
    assert counted(docs, cache) == expected
    held = spark.read.parquet(cache).groupBy("digest").count()
    assert held.where("count = 1").count() > 0 and held.where("count = 2").count() > 0
    assert counted(docs.union(docs).dropDuplicates(["doc_id"]), cache) == expected


def test_repeated_rows_and_empty_tables(spark, docs, expected):
    cache = new_folder(spark, "cache")
    assert tokens.count_tokens(docs.where("doc_id < 0"), FILE, cache).collect() == []
    rows = tokens.count_tokens(docs.union(docs), FILE, cache, keep=["doc_id"]).collect()
    assert sorted((r["doc"]["doc_id"], r["n_tokens"]) for r in rows) == sorted((k, n) for k, (_, n) in [*expected.items()] * 2)


def test_ranks_of_another_vocabulary_are_refused():
    with pytest.raises(ValueError, match="another vocabulary"):
        tokens.Ranks(files.path("byte_bpe_multi_50k.tiktoken"), FILE, files.PATTERN)
