"""Jaccard join of documents by their word n-grams, with rare-first prefix filtering.

Texts with the same set of n-grams are one class and are compared once. The join runs in two steps.

Step one drops what can have no partner. A partner shares at least the threshold's part of a set, so n-grams
of one class alone, which are most of any corpus, must be few. Each task packs the n-grams of some thousand
texts as sorted cells of the hash space, and an exchange by range of cells finds those that more than one text
holds; only how many of its n-grams are shared goes back to each text. A cell that several texts of one pack
hold is sent once, so an n-gram that very many texts hold stays small. Cells are wider than the number of all
n-grams at any size; an accidental meeting keeps a text that would have gone, and loses none.

Step two orders the n-grams of each class that is left by how rare they are among them (powers of two, then
the hash) and joins prefixes: two sets that reach the threshold share an n-gram among the first
n - ceil(t * n) + 1 of either. Pairs must pass the length filter and the positional filter, are made distinct,
and are then verified once: the suffix filter bounds their difference by binary searches, and what passes is
intersected. Members of a prefix cell meet the cell's centre first (the class with the fewest n-grams of its
own). Pairs that this connects need no further look when only components are asked for, so a group of near
copies costs a link for each of its members; only classes that are still apart are paired in full.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallyhouse.llm.components import components
from tallyhouse.llm.store import Spool

#: n-grams and texts that a task packs together, and n-grams that one range of cells holds.
PACK, PACKED_TEXTS, RANGE = 1 << 21, 50_000, 1 << 21
#: Bytes of text that are hashed at once, and classes that a task remembers.
STRETCH, SEEN = 1 << 20, 1 << 18
#: How often the suffix filter halves both sides.
DEPTH = 3

_MASK = (1 << 64) - 1
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_SEVERAL = 0xFFFF


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbers(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit numbers that depend on the seed only."""
    return _mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(count, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


_BYTES = _numbers(256, 1)
_BYTES[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
_BASE = 0x9E6F0D6F1F1B8B4D
_LOW, _HIGH = _powers(_BASE, 1 << 16), pow(_BASE, 1 << 16, 1 << 64)


def _word_hashes(buffer: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts that lie side by side, and how many words each text has."""
    space = _SPACE[buffer]
    word = ~space
    first = word.copy()
    first[1:] &= space[:-1]
    heads = edges[:-1][edges[:-1] < len(buffer)]
    first[heads] = word[heads]
    first = np.flatnonzero(first)
    if not len(first):
        return np.empty(0, np.uint64), np.zeros(len(edges) - 1, np.int64)
    values = _BYTES[buffer[word]]
    begin = np.cumsum(word)[first] - 1
    lengths = np.diff(np.append(begin, len(values)))
    within = np.arange(len(values)) - np.repeat(begin, lengths)
    values *= _LOW[within & 0xFFFF]
    if lengths.max() > 1 << 16:
        values *= _powers(_HIGH, int(lengths.max() >> 16) + 1)[within >> 16]
    hashes = _mixed(np.add.reduceat(values, begin) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes, np.diff(np.searchsorted(first, edges))


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted 64-bit hashes of its distinct n-grams; a shorter sequence is one n-gram."""
    plain = pa.compute.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = plain.buffers()
    edges = np.frombuffer(offsets, np.int64)[plain.offset : plain.offset + len(plain) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    factors = _numbers(size, 2)
    low = 0
    while low < len(plain):
        high = max(low + 1, int(np.searchsorted(edges, edges[low] + STRETCH, "right")) - 1)
        words, counts = _word_hashes(data[edges[low] : edges[high]], edges[low : high + 1] - edges[low])
        whole = max(len(words) - size + 1, 0)
        sums = np.zeros(whole, np.uint64)
        for j in range(size):
            sums += words[j : j + whole] * factors[j]
        grams, at = _mixed(sums), 0
        for n in counts.tolist():
            if n >= size:
                yield np.unique(grams[at : at + n - size + 1])
            elif n:
                short = (words[at : at + n] * factors[:n]).sum(dtype=np.uint64) + np.uint64(n)
                yield _mixed(np.array([short], np.uint64))
            else:
                yield words[:0]
            at += n
        low = high


def pack(cells: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending whole numbers as 16-bit steps, and the steps that need more bits by their places."""
    steps = np.diff(cells, prepend=np.uint64(0))
    far = np.flatnonzero(steps >> np.uint64(16)).astype(np.uint64)
    more = np.stack([far, steps[far.astype(np.int64)] >> np.uint64(16)]).astype("<u8") if len(far) else far
    return steps.astype("<u2").tobytes(), more.tobytes()


def unpack(steps: bytes, more: bytes) -> np.ndarray:
    found = np.frombuffer(steps, "<u2").astype(np.uint64)
    if more:
        at, high = np.frombuffer(more, "<u8").reshape(2, -1)
        found[at.astype(np.int64)] |= high << np.uint64(16)
    return np.cumsum(found, dtype=np.uint64)


_PACKED = "sig binary, n long, pack binary, slot int, cells binary, more binary, who binary"


def _batch(doc: pa.Array | None, kind: pa.DataType, rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split(" ")[0] for x in _PACKED.split(", ")]
    kinds = [pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays([pa.nulls(len(rows), kind) if doc is None else doc, *columns], ["doc", *names])


def _packs(size: int, bits: int, ranges: int):
    """Tasks of step one: a row for each text, and a pack's head and its cells by range."""
    shift, inner = np.uint64(64 - bits), np.uint64(bits - (ranges.bit_length() - 1))

    def emptied(sets: list[np.ndarray], sigs: list[bytes], kind: pa.DataType) -> pa.RecordBatch:
        counts = np.array([len(x) for x in sets])
        cells = np.concatenate(sets) >> shift
        order = np.argsort(cells)
        cells, who = cells[order], np.repeat(np.arange(len(sets)), counts)[order]
        starts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
        runs = np.diff(np.append(starts, len(cells)))
        credit = np.bincount(who[np.repeat(runs > 1, runs)], minlength=len(sets))
        cells, who = cells[starts], np.where(runs > 1, _SEVERAL, who[starts]).astype("<u2")
        name = uuid.uuid4().bytes
        rows = [(b"".join(sigs), None, name, -1, counts.astype("<u4").tobytes(), None, credit.astype("<u4").tobytes())]
        edges = np.searchsorted(cells >> inner, np.arange(ranges + 1, dtype=np.uint64))
        for slot, (i, j) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            if i < j:
                packed = pack(cells[i:j] & ((np.uint64(1) << inner) - np.uint64(1)))
                rows.append((None, None, name, slot, *packed, who[i:j].tobytes()))
        return _batch(None, kind, rows)

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: list[np.ndarray] = []
        sigs: list[bytes] = []
        seen: set[bytes] = set()
        held, kind = 0, None
        for batch in batches:
            kind, rows = batch.column("doc").type, []
            for grams in shingle_sets(batch.column("text"), size):
                sig = xxhash.xxh3_128_digest(grams.tobytes())
                rows.append((sig, len(grams), None, None, None, None, None))
                if len(grams) and sig not in seen:
                    seen.add(sig)
                    sets.append(grams)
                    sigs.append(sig)
                    held += len(grams)
                    if held >= PACK or len(sets) >= PACKED_TEXTS:
                        yield emptied(sets, sigs, kind)
                        sets, sigs, seen, held = [], [], set(), 0
            if rows:
                yield _batch(batch.column("doc"), kind, rows)
        if sets:
            yield emptied(sets, sigs, kind)

    return packs


def _met(table: pa.Table) -> pa.Table:
    """For each pack of one range how many cells of its texts other packs hold too."""
    names, found = table["pack"].to_pylist(), []
    parts = [
        (unpack(c, m), np.frombuffer(w, "<u2"))
        for c, m, w in zip(*(table[x].to_pylist() for x in ("cells", "more", "who")), strict=True)
    ]
    cells = np.concatenate([c for c, _ in parts])
    order = np.argsort(cells)
    same = cells[order][1:] == cells[order][:-1]
    shared = np.zeros(len(cells), bool)
    shared[order[1:]] = same
    shared[order[:-1]] |= same
    at = 0
    for _, who in parts:
        own = who[shared[at : at + len(who)] & (who != _SEVERAL)]
        at += len(who)
        texts, times = np.unique(own, return_counts=True)
        found.append((texts.astype("<u2").tobytes(), times.astype("<u4").tobytes()))
    return pa.table(
        {"pack": pa.array(names, pa.binary()), "who": pa.array([x for x, _ in found], pa.binary()),
         "times": pa.array([x for _, x in found], pa.binary())}
    )


def _left(percent: int):
    def left(table: pa.Table) -> pa.Table:
        """The texts of one pack of which enough n-grams are shared."""
        rows = table.select(["who", "times", "sigs", "counts"]).to_pylist()
        head = next(r for r in rows if r["sigs"] is not None)
        counts = np.frombuffer(head["counts"], "<u4").astype(np.int64)
        shared = np.frombuffer(head["times"], "<u4").astype(np.int64)
        for r in rows:
            if r["sigs"] is None:
                shared[np.frombuffer(r["who"], "<u2")] += np.frombuffer(r["times"], "<u4")
        kept = np.flatnonzero(100 * shared >= percent * counts).tolist()
        return pa.table({"sig": pa.array([head["sigs"][16 * k : 16 * k + 16] for k in kept], pa.binary())})

    return left


def _signed(size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts with their class; a class that a task has seen lately is not sent again."""
        seen: set[bytes] = set()
        for batch in batches:
            sigs, new = [], []
            for k, grams in enumerate(shingle_sets(batch.column("text"), size)):
                sig = xxhash.xxh3_128_digest(grams.tobytes())
                if sig not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(sig)
                    sigs.append(sig)
                    new.append(k)
            if new:
                texts = batch.column("text").take(pa.array(new))
                yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.binary()), texts], ["sig", "text"])

    return sign


def _listed(size: int):
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [x.view(np.int64) for x in shingle_sets(batch.column("text"), size)]
            edges = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
            grams = pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("sig"), grams], ["sig", "grams"])

    return listed


def least_difference(x: np.ndarray, y: np.ndarray, most: int, depth: int = DEPTH) -> int:
    """A lower bound of how many elements only one of two ascending arrays holds.

    Both are cut at the middle element of `y`, found in `x` by binary search: what lies on different sides of
    it cannot be common. A bound above `most` is returned as soon as it is found.
    """
    if not depth or not len(x) or not len(y):
        return abs(len(x) - len(y))
    middle = len(y) // 2
    at = int(np.searchsorted(x, y[middle]))
    held = at < len(x) and x[at] == y[middle]
    left, right = (x[:at], y[:middle]), (x[at + held :], y[middle + 1 :])
    apart = [abs(len(a) - len(b)) for a, b in (left, right)]
    found = sum(apart) + (not held)
    if found > most:
        return found
    low = least_difference(*left, most - apart[1] - (not held), depth - 1)
    found = low + apart[1] + (not held)
    if found > most:
        return found
    return low + least_difference(*right, most - low - (not held), depth - 1) + (not held)


def _verified(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("a", "b", "na", "nb")]
            lists = [batch.column(c) for c in ("ka", "kb")]
            values = [x.flatten().to_numpy() for x in lists]
            edges = [x.offsets.to_numpy() - x.offsets[0].as_py() for x in lists]
            good = []
            for k, (na, nb) in enumerate(zip(columns[2].tolist(), columns[3].tolist(), strict=True)):
                x, y = (v[e[k] : e[k + 1]] for v, e in zip(values, edges, strict=True))
                # n-grams of one class alone are in neither list and are never common
                need = -(-percent * (na + nb) // (100 + percent))
                if least_difference(x, y, len(x) + len(y) - 2 * need) > len(x) + len(y) - 2 * need:
                    continue
                common = len(np.intersect1d(x, y, assume_unique=True))
                if common >= need:
                    good.append((columns[0][k], columns[1][k], common))
            if good:
                out = (pa.array(c, pa.int64()) for c in zip(*good, strict=True))
                yield pa.RecordBatch.from_arrays(list(out), ["a", "b", "common"])

    return verify


class NgramJoin:
    """The classes of a table's texts, and the links between them.

    `rows` holds `doc` (a struct of the columns `keep`, by default all), `sig` (the class) and `n` (the size of
    its set, 0 without words) for every row of `docs`; null counts as empty. `classes` holds `sig`, `node` (a
    number), `n` and `keys` (shared n-grams, rarest first) of every class that may have a partner.
    """

    def __init__(
        self, docs: DataFrame, text: str = "text", keep: list[str] | None = None, size: int = 5, percent: int = 80
    ):
        if size < 1 or not 0 < percent <= 100:
            raise ValueError("n-grams need a word and the threshold is a percentage above 0")
        self.size, self.percent = size, percent
        self.spool = Spool(docs.sparkSession, "ngrams")
        keep = docs.columns if keep is None else keep
        given = docs.select(F.struct(*keep).alias("doc"), F.col(text).alias("text"))
        bytes_ = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0
        most = max(bytes_ // 2, 1)  # a word needs a byte and a separator
        ranges = 1 << max(0, (most // (2 * RANGE)).bit_length())
        bits = min(64, max(most.bit_length() + 2, ranges.bit_length() + 16))
        schema = StructType([StructField("doc", given.schema["doc"].dataType), *StructType.fromDDL(_PACKED)])
        packed = self.spool.write(given.mapInArrow(_packs(size, bits, ranges), schema))
        self.rows = packed.where("pack IS NULL").select("doc", "sig", "n")
        self.classes = self._classes(given.select("text"), self._partners(packed))

    def _partners(self, packed: DataFrame) -> DataFrame:
        """The classes of which enough n-grams are shared."""
        none = F.lit(None).cast("binary")
        heads = packed.where("slot = -1").select(
            "pack", none.alias("who"), F.col("who").alias("times"), F.col("sig").alias("sigs"), F.col("cells").alias("counts")
        )
        met = (
            packed.where("slot >= 0")
            .select("slot", "pack", "cells", "more", "who")
            .groupBy("slot")
            .applyInArrow(_met, "pack binary, who binary, times binary")
            .select("*", none.alias("sigs"), none.alias("counts"))
        )
        return met.unionByName(heads).groupBy("pack").applyInArrow(_left(self.percent), "sig binary")

    def _classes(self, texts: DataFrame, partners: DataFrame) -> DataFrame:
        # always a shuffle: the partners are no few rows of a large table
        signed = texts.mapInArrow(_signed(self.size), "sig binary, text string")
        one = signed.join(partners.hint("merge"), "sig", "left_semi").groupBy("sig").agg(F.first("text").alias("text"))
        sets = self.spool.write(
            one.mapInArrow(_listed(self.size), "sig binary, grams array<long>").withColumn(
                "node", F.monotonically_increasing_id()
            )
        )
        grams = sets.select("node", F.explode("grams").alias("gram"))
        often = self.spool.write(grams.groupBy("gram").agg(F.count("*").alias("often")).where("often > 1"))
        # one number orders n-grams by powers of two of their frequency, and then by their hash
        key = F.shiftleft(F.floor(F.log2("often")).cast("long"), 57).bitwiseOR(F.shiftrightunsigned("gram", 7))
        keys = (
            grams.join(often, "gram")
            .groupBy("node")
            .agg(F.sort_array(F.collect_list(key)).alias("keys"))  # no more than the text has words
        )
        classes = self.spool.write(
            sets.select("sig", "node", F.size("grams").cast("long").alias("n")).join(keys, "node")
        )
        self.spool.drop(sets, often)
        return classes

    def postings(self) -> DataFrame:
        """(key, node, n, own, at): the shared n-grams in each class's prefix; `own` are not shared at all."""
        prefix = F.expr(f"n - (n * {self.percent} + 99) div 100 + 1")
        own = (F.col("n") - F.size("keys")).cast("long")
        first = F.slice("keys", 1, F.greatest(prefix - own, F.lit(0)).cast("int"))
        return (
            self.classes.select("node", "n", own.alias("own"), first.alias("keys"))
            .select("node", "n", "own", F.posexplode("keys").alias("at", "key"))
            .select("key", "node", "n", "own", (F.col("at") + F.col("own")).alias("at"))
        )

    def _may_link(self, a: str, b: str) -> Column:
        """Length filter, and positional filter for the first n-gram in which a pair meets."""
        na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
        after = F.least(na - F.col(f"{a}.at"), nb - F.col(f"{b}.at"))
        return (
            (100 * na >= self.percent * nb)
            & (100 * nb >= self.percent * na)
            & ((100 + self.percent) * after >= self.percent * (na + nb))
        )

    def _verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that reach the threshold, with the size of what they share."""
        sides = {
            s: self.classes.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("keys").alias(f"k{s}"))
            for s in "ab"
        }
        return (
            pairs.join(sides["a"], "a").join(sides["b"], "b").select("a", "b", "na", "nb", "ka", "kb")
            .mapInArrow(_verified(self.percent), "a long, b long, common long")
        )

    def _pairs(self, one: DataFrame, two: DataFrame, when: Column) -> DataFrame:
        met = one.alias("x").join(two.alias("y"), F.col("x.key") == F.col("y.key"))
        near = met.where(when & self._may_link("x", "y"))
        return near.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()

    def links(self) -> DataFrame:
        """All pairs of linked classes (a, b: numbers of `classes`, a < b) with `common`, each verified once."""
        posted = self.postings()
        return self._verify(self._pairs(posted, posted, F.col("x.node") < F.col("y.node")))

    def roots(self) -> DataFrame:
        """(sig, root) for every class that has a link; root numbers the component."""
        spool, posted = self.spool, self.postings()
        centre = posted.groupBy("key").agg(F.min(F.struct("own", "node", "n", "at")).alias("c"), F.count("*").alias("held"))
        centre = centre.where("held > 1").select("key", "c.*")
        first = spool.write(self._verify(self._pairs(posted, centre, F.col("x.node") != F.col("y.node"))))
        joined = components(first, spool)

        # of each cell the largest component is one side, and all classes outside of it the other
        placed = posted.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
        sizes = placed.groupBy("key", "root").agg(F.count("*").alias("held"))
        main = sizes.groupBy("key").agg(F.max(F.struct("held", "root")).alias("m"), F.count("*").alias("parts"))
        apart = placed.join(main.where("parts > 1").select("key", F.col("m.root").alias("main")), "key")
        differ = (F.col("x.root") != F.col("y.root")) & ((F.col("y.root") == F.col("y.main")) | (F.col("x.node") < F.col("y.node")))
        second = spool.write(self._verify(self._pairs(apart.where("root <> main"), apart, differ)))
        if second.first() is not None:
            joined = components(first.unionByName(second).select("a", "b"), spool)
        return joined.join(self.classes, "node").select("sig", "root")


def component_ids(
    docs: DataFrame,
    text: str = "text",
    identifier: str = "doc_id",
    keep: list[str] | None = None,
    size: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Every row of `docs` with the smallest identifier that links reach.

    Returns `doc` (a struct of the columns `keep`, by default all; it must hold the identifier), `n` and
    `component_id`. A-Z are lower-cased, words are runs without ASCII white space, and texts of fewer words than
    `size` are one n-gram. Null and empty texts have an empty set, are linked with nothing and keep their own
    identifier. Equal sets are linked, so repeated rows share a component; identifiers that are null are passed
    over, and a component of such rows alone has none. Empty tables give no rows.
    """
    join = NgramJoin(docs, text, keep, size, percent)
    spool = join.spool
    named = spool.write(
        join.rows.join(join.roots(), "sig", "left").withColumn("id", F.col("doc")[identifier])
    )
    key = ["root", F.when(F.col("root").isNull(), F.col("sig")).alias("sig")]
    least = spool.write(named.where("n > 0").groupBy(*key).agg(F.min("id").alias("component_id")))
    alone, of_root = least.where("root IS NULL").drop("root"), least.where("root IS NOT NULL").drop("sig")
    out = lambda df, c="component_id": df.select("doc", "n", F.col(c).alias("component_id"))
    return (
        out(named.where("n = 0"), "id")
        .unionByName(out(named.where("n > 0 AND root IS NULL").join(alone, "sig")))
        .unionByName(out(named.where("n > 0 AND root IS NOT NULL").join(of_root, "root")))
    )
