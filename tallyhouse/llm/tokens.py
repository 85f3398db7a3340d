"""Token counts kept in a cache of digests.

A text is known by the SHA-256 of its bytes, a tokenizer by that of its file and how it is used. Counts
already in the cache are joined; of the others each distinct text is encoded once and its count appended.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from importlib import metadata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.alignment import Vocabulary
from tallyhouse.llm.store import Spool, exists

CACHE = "tokenizer binary, digest binary, n_tokens long"
#: Texts that are encoded at once.
BATCH = 256


def tokenizer_digest(file: str) -> bytes:
    """Which tokenizer counts: its file, library, version and settings."""
    with open(file, "rb") as source:
        content = source.read()
    library = "sentencepiece" if file.endswith(".model") else "tokenizers"
    said = f"{library} {metadata.version(library)}, whole texts, no added tokens\n"
    return hashlib.sha256(said.encode() + content).digest()


def _encoder(name: str, content: bytes):
    """A function from texts to token counts, without added tokens, truncation or padding."""
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_buffer(content)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]


class Ranks:
    """A rank file of the vocabulary of a `tokenizers` file, which encodes the same several times faster.

    Texts that hold the string of an added token go to the tokenizer itself.
    """

    def __init__(self, file: str, tokenizer: str, pattern: str):
        self.vocabulary = Vocabulary(file, pattern=pattern)
        with open(tokenizer, encoding="utf-8") as source:
            self.added = tuple(token["content"] for token in json.load(source).get("added_tokens", ()))
        own, other = self.vocabulary.tokens, Vocabulary(tokenizer).tokens
        if own != other[: len(own)] or any(other[len(own) :]):
            raise ValueError(f"{file} holds another vocabulary than {tokenizer}")

    def counter(self, whole):
        """A function from texts to token counts, by the ranks where they are enough and else by `whole`."""
        encode = self.vocabulary.encoder()

        def count(texts: list[str]) -> list[int]:
            found = list(map(len, encode(texts)))
            rest = [k for k, x in enumerate(texts) if any(token in x for token in self.added)]
            for k, n in zip(rest, whole([texts[k] for k in rest]), strict=True):
                found[k] = n
            return found

        return count


def _encoded(name: str, content: bytes, ranks: Ranks | None):
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = _encoder(name, content)
        count = ranks.counter(count) if ranks else count
        for batch in batches:
            numbers: list[int] = []
            for start in range(0, len(batch), BATCH):
                numbers += count(batch["text"].iloc[start : start + BATCH].tolist())
            yield pd.DataFrame({"digest": batch["digest"], "n_tokens": numbers})

    return encode


def open_cache(docs: DataFrame, path: str) -> DataFrame:
    """The counts stored at `path`; an empty cache is made where there is none."""
    spark = docs.sparkSession
    if not exists(spark, path):
        spark.createDataFrame([], CACHE).write.parquet(path)
    return spark.read.schema(CACHE).parquet(path)


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    cache: str,
    text: str = "text",
    keep: list[str] | None = None,
    ranks: Ranks | None = None,
) -> DataFrame:
    """`doc` (a struct of the columns `keep`, by default all), `n_bytes` and `n_tokens` of every text.

    `tokenizer` is a file on the driver; its content travels with the job, as do `ranks` where given. A null text counts as empty and
    has no tokens. Texts are not normalised, as any change could change their tokens: texts that agree in
    their digest are encoded once. Counts of texts that `cache` does not hold are appended to it before the
    result is read from it; a job that fails before leaves the cache as it was. A digest that the cache holds
    more than once, after two writers or a repeated job, counts once. The distinct misses are combined before the
    shuffle, and the join with the counts reads tables on both sides, so a text that very many rows share can be
    split over tasks. Repeated rows are rows of their own; an empty table gives no rows.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    with open(tokenizer, "rb") as source:
        content = source.read()
    keep = docs.columns if keep is None else keep
    said = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.struct(*keep).alias("doc"),
        F.octet_length(said).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(said, 256)).alias("digest"),
        said.alias("text"),
    )
    known = open_cache(docs, cache).where(F.col("tokenizer") == F.lit(version)).select("digest")
    misses = rows.select("digest", "text").distinct().join(known, "digest", "left_anti")
    (
        misses.mapInPandas(_encoded(tokenizer, content, ranks), "digest binary, n_tokens long")
        .select(F.lit(version).alias("tokenizer"), "digest", "n_tokens")
        .write.mode("append")
        .parquet(cache)
    )
    stored = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == F.lit(version))
    # two writers, or a job that ran again, may have appended a digest twice; its counts are equal
    spool = Spool(spark, "token-counts")
    once = spool.write(stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    return rows.drop("text").join(once, "digest").select("doc", "n_bytes", "n_tokens")
