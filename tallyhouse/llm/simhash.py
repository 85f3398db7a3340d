"""SimHash near duplicates, found around the words of a covering code.

Fingerprints have 64 bits. If two differ in at most 3 bits, one of their halves differs in at most
one. Each half of 32 bits is covered by the perfect Hamming code of 31 bits, extended by one free bit:
every half lies within radius 1 of exactly one code word, its home anchor. A fingerprint is sent to
every anchor within radius 1 + 1 of each half (at most 17), so a pair whose halves differ in at most
one bit always meets at the home anchor of either. There the fingerprints at home are compared with all
that were sent. Equal fingerprints are one node, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.components import components
from tallyhouse.llm.store import Spool

MAX_BITS = 3
SEED = 42
#: Fingerprints compared at once in one task; cells above it are cut into blocks.
BLOCK = 4096
#: Cells up to this size are compared together with their neighbours in one vector operation.
SMALL = 32

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def _fingerprint(text: str | None, shingle: int) -> int:
    """The signed 64-bit SimHash of a text; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, SEED)], dtype=np.uint64)
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (
                digest(line[i:j], SEED)
                for i, j in zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=False)
            ),
            np.uint64,
            len(words) - shingle + 1,
        )
    octets = hashes.view(np.uint8).reshape(-1, 8)
    counts = np.concatenate(
        [np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)]
    )
    bits = (2 * counts > len(hashes)).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum().astype(np.int64))


def fingerprints(docs: DataFrame, text: str, shingle: int, name: str = "fingerprint") -> DataFrame:
    """`docs` with the signed 64-bit SimHash of `text` over word shingles.

    A-Z are lower-cased, words are runs without ASCII white space, repeated shingles count again, and a
    text with fewer words than a shingle is one shingle. No words or a null text: 0.
    """

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([_fingerprint(x, shingle) for x in texts], dtype="int64")

    return docs.withColumn(name, hashed(F.col(text)))


def _home(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Home anchors of 32-bit halves, and the syndrome of their lower 31 bits."""
    syndrome = np.zeros(len(half), np.int64)
    for bit in range(31):
        syndrome ^= ((half >> bit) & 1) * (bit + 1)
    return half ^ np.where(syndrome > 0, 1 << np.maximum(syndrome - 1, 0), 0), syndrome


def _anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, anchor, at home) of every anchor within radius 2 of 32-bit halves."""
    index = np.arange(len(half))
    home, syndrome = _home(half)
    found = [(index, home, np.ones(len(half), bool)), (index, home ^ (1 << 31), np.zeros(len(half), bool))]
    for column in range(1, 32):
        other = column ^ syndrome
        fits = (syndrome > 0) & (other > column)
        at = index[fits]
        anchor = half[fits] ^ (1 << (column - 1)) ^ (1 << (other[fits] - 1))
        found.append((at, anchor, np.zeros(len(at), bool)))
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def _sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        prints = batch["fp"].to_numpy(np.int64)
        for start in range(0, len(prints), 20_000):
            part = prints[start : start + 20_000]
            for half in (0, 1):
                at, anchor, home = _anchors((part >> (32 * half)) & 0xFFFFFFFF)
                yield pd.DataFrame({"cell": (anchor << 1) | half, "fp": part[at], "home": home})


def _forest(homes: np.ndarray, members: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what lies within `bits` of each other, at most one per member."""
    nodes, at = np.unique(np.concatenate([homes, members]), return_inverse=True)
    label = np.arange(len(nodes))
    where = at[len(homes) :]
    for k, home in enumerate(homes):
        near = where[np.bitwise_count((members ^ home).view(np.uint64)) <= bits]
        old = np.unique(label[np.append(near, at[k])])
        if len(old) > 1:
            label[np.isin(label, old)] = old[0]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _links(rows: pd.DataFrame, bits: int) -> list[pd.DataFrame]:
    """Links within whole cells; rows are sorted by cell."""
    edge = rows["key"].to_numpy()
    starts = np.flatnonzero(np.append(True, edge[1:] != edge[:-1]))
    sizes = np.diff(np.append(starts, len(edge)))
    prints, home, member = (rows[c].to_numpy() for c in ("fp", "home", "member"))
    found = []
    size = np.repeat(sizes, sizes)
    start = np.repeat(starts, sizes)
    few = np.flatnonzero(home & (size <= SMALL))
    if len(few):
        one = np.repeat(few, size[few])
        step = np.arange(len(one)) - np.repeat(np.cumsum(size[few]) - size[few], size[few])
        two = start[one] + step
        a, b = prints[one], prints[two]
        near = member[two] & (a != b) & (np.bitwise_count((a ^ b).view(np.uint64)) <= bits)
        found.append(pd.DataFrame({"a": a[near], "b": b[near]}))
    for k in np.flatnonzero(sizes > SMALL):
        part = slice(starts[k], starts[k] + sizes[k])
        a, b = _forest(prints[part][home[part]], prints[part][member[part]], bits)
        found.append(pd.DataFrame({"a": a, "b": b}))
    return found


def _compared(bits: int):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(rows):
                continue
            whole = (rows["key"] != rows["key"].iloc[-1]).to_numpy()
            cut = int(whole.sum())
            rest = rows.iloc[cut:].reset_index(drop=True)
            if cut:
                yield from _links(rows.iloc[:cut].reset_index(drop=True), bits)
        if rest is not None and len(rest):
            yield from _links(rest, bits)

    return compare


def links(prints: DataFrame, spool: Spool, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect all fingerprints of `prints(fp)` at most `max_bits` apart.

    `prints` holds each fingerprint once and is read more than once. Two fingerprints are connected by
    the result exactly if a chain of such pairs joins them; large cells return a spanning forest, not
    all pairs. A cell of more than `block` members is compared in blocks of homes against blocks of
    members, so no task holds more than two blocks of a cell.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the covering of halves holds for at most 3 differing bits")
    sent = prints.select("fp").mapInPandas(_sent, "cell long, fp long, home boolean")
    cells = spool.write(
        sent.groupBy("cell")
        .agg(F.count("*").alias("n"), F.sum(F.col("home").cast("long")).alias("homes"))
        .where("n > 1 and homes > 0")
    )
    blocks = lambda n: F.ceil(F.col(n) / block).cast("int")
    own = lambda n: F.pmod(F.xxhash64("fp"), blocks(n)).cast("int")
    row = lambda i, j, home, member: F.struct(
        i.cast("int").alias("i"), j.cast("int").alias("j"), home.alias("home"), member.alias("member")
    )
    yes, no = F.lit(True), F.lit(False)
    met = sent.join(cells, "cell")
    whole = met.where(F.col("n") <= block).select(
        "cell", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp", "home", yes.alias("member")
    )
    cut = met.where(F.col("n") > block).select(
        "cell",
        "fp",
        F.explode(
            F.concat(
                F.transform(F.sequence(F.lit(0), blocks("homes") - 1), lambda i: row(i, own("n"), no, yes)),
                F.when(
                    F.col("home"),
                    F.transform(
                        F.sequence(F.lit(0), blocks("n") - 1), lambda j: row(own("homes"), j, yes, no)
                    ),
                ).otherwise(F.array().cast("array<struct<i:int,j:int,home:boolean,member:boolean>>")),
            )
        ).alias("to"),
    ).select("cell", "to.i", "to.j", "fp", "to.home", "to.member")
    return (
        whole.unionByName(cut)
        .withColumn("key", F.concat_ws(":", "cell", "i", "j"))
        .select("key", "fp", "home", "member")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInPandas(_compared(max_bits), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    shingle: int = 3,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Fingerprint and component of every row of `docs`.

    Returns `doc` (a struct of the columns `keep`, by default all, so that no name can clash), `row` (a
    number of the row), `fingerprint` (signed) and `component` (the smallest fingerprint that chains of
    links of at most `max_bits` differing bits reach). Null and empty texts have fingerprint 0 and are
    linked like any other. Repeated rows are rows of their own with one fingerprint.
    """
    spool = Spool(docs.sparkSession, "simhash")
    keep = docs.columns if keep is None else keep
    packed = docs.select(F.struct(*keep).alias("doc"), F.col(text).alias("text"))
    rows = spool.write(
        fingerprints(packed, "text", shingle).select(
            "doc", "fingerprint", F.monotonically_increasing_id().alias("row")
        )
    )
    prints = spool.write(rows.select(F.col("fingerprint").alias("fp")).distinct())
    found = spool.write(links(prints, spool, max_bits))
    roots = spool.write(components(found, spool))
    full = spool.write(
        prints.join(roots, prints["fp"] == roots["node"], "left").select(
            F.col("fp").alias("fingerprint"), F.coalesce("root", "fp").alias("component")
        )
    )
    spool.drop(found, prints, roots)
    return rows.join(full, "fingerprint").select("doc", "row", "fingerprint", "component")


def component_ids(rows: DataFrame, identifier: str = "doc_id") -> DataFrame:
    """`rows` of near_duplicates with `component_id` and `first_row`: the smallest identifier of the
    component (nulls last) and the number of the first row that has it.

    The minimum is combined before the shuffle and written, so a component with very many rows can be
    split over tasks in the join back.
    """
    spool = Spool(rows.sparkSession, "simhash-ids")
    value = F.col("doc")[identifier]
    least = F.min(F.struct(value.isNull().alias("none"), value.alias("id"), "row"))
    first = spool.write(rows.groupBy("component").agg(least.alias("least")))
    return (
        rows.join(first, "component")
        .withColumns({"component_id": F.col("least.id"), "first_row": F.col("least.row")})
        .drop("least")
    )


def drop_near_duplicates(
    docs: DataFrame, text: str = "text", identifier: str = "doc_id", **options
) -> DataFrame:
    """`docs` with one row of each component: the first with the smallest identifier (nulls last)."""
    rows = component_ids(near_duplicates(docs, text, **options), identifier)
    return rows.where(F.col("row") == F.col("first_row")).select("doc.*")
