"""Alignment of two tokenizers over the same bytes, in equal pieces of the merge of their token ends.

The ends of a text's A tokens and B tokens are two sorted lists. Their merge (A first where both end) is cut
at every `STEPS`-th diagonal; a binary search on the diagonal says how many ends of either list lie before it,
so each piece is a slice of both lists that is merged without the others. Pieces are rows, written once, and
every later job reads them independently: a text of any length is many rows of bounded size.

Every distinct end closes one stretch of bytes that exactly one A and one B token cover, so a piece emits one
link per distinct end. A group ends where both lists have an end; groups that reach over the edge of a piece
are put together from the open parts of neighbouring pieces.

How often an id pair is linked in the whole corpus is summed before the shuffle. Pairs that hold at least one
of `HEAVY` parts of all links (so at most `HEAVY` pairs, at any size of the corpus) travel to the tasks; links
of all other pairs are joined to their counts in a shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.llm.store import Spool

#: Steps of the merge in one piece.
STEPS = 1 << 15
#: Pairs with this part of all links are looked up in the tasks: at most so many pairs.
HEAVY = 1 << 20
#: Links whose distinct pairs are counted at once in a task, and bytes of ids in one Arrow batch.
AT_ONCE, BATCH = 1 << 21, 1 << 22

_ARROW = {
    "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_(),
    "array<long>": pa.list_(pa.int64()),
}
PIECES = "row long, piece int, pieces int, n_a int, n_b int, a_base long, b_base long, a binary, b binary"
MERGED = (
    "row long, pieces int, piece int, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "sha string, closes boolean, head_a string, head_b string, middle string, tail_a string, tail_b string, "
    "codes array<long>, times array<long>"
)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows as an Arrow batch of the columns of a schema text."""
    fields = [x.split(" ") for x in schema.split(", ")]
    columns = zip(fields, zip(*rows, strict=True), strict=True)
    return pa.RecordBatch.from_pydict({name: pa.array(x, _ARROW[kind]) for (name, kind), x in columns})


class Vocabulary:
    """The bytes of every token id, and how texts become ids without special tokens.

    A `.tiktoken` file holds ranks, a `.json` file is one of `tokenizers`, a `.model` file one of
    `sentencepiece`. `before` is put in front of each text.
    """

    def __init__(self, file: str, before: str = "", pattern: str | None = None):
        self.file, self.before, self.pattern = file, before, pattern
        with open(file, "rb") as source:
            self.content = source.read()
        self.tokens = getattr(self, "_" + file.rsplit(".", 1)[-1])()[1]
        self.lossless = file.endswith(".tiktoken") and {bytes([x]) for x in range(256)} <= set(self.tokens)

    def _tiktoken(self):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.content.splitlines())}
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        model = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [model.encode_ordinary(x) for x in texts], tokens

    def _json(self):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_buffer(self.content)
        model.encode_special_tokens = True
        model.no_truncation()
        model.no_padding()
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [x for x in range(256) if x not in plain]
        shown = {chr(x): x for x in plain} | {chr(256 + n): x for n, x in enumerate(rest)}
        tokens = [b""] * model.get_vocab_size(with_added_tokens=True)
        for token, k in model.get_vocab(with_added_tokens=False).items():
            tokens[k] = bytes(shown[c] for c in token) if all(c in shown for c in token) else b""
        return lambda texts: [x.ids for x in model.encode_batch_fast(texts, add_special_tokens=False)], tokens

    def _model(self):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=self.content)
        tokens = [
            bytes([int(x[3:5], 16)]) if model.is_byte(k) else x.replace("▁", " ").encode()
            for k, x in ((k, model.id_to_piece(k)) for k in range(model.get_piece_size()))
        ]
        return lambda texts: model.encode(texts, num_threads=1), tokens

    def encoder(self):
        """A function from texts to lists of ids; loads the model, so it is called once in a task."""
        encode = getattr(self, "_" + self.file.rsplit(".", 1)[-1])()[0]
        return lambda texts: encode([self.before + x for x in texts])

    def restores(self, ids: list[int], said: bytes) -> bool:
        """Whether the tokens join to the given bytes. Plain ranks hold every byte, so they always do."""
        return self.lossless or b"".join(map(self.tokens.__getitem__, ids)) == said

    @property
    def lengths(self) -> np.ndarray:
        return np.array([len(x) for x in self.tokens], np.int64)

    @property
    def kind(self) -> np.dtype:
        """The narrowest unsigned type that holds every id."""
        return np.dtype(np.uint16 if len(self.tokens) <= 1 << 16 else np.uint32)

    @property
    def code(self) -> str:
        return "H" if self.kind.itemsize == 2 else "I"


def cuts(a: np.ndarray, b: np.ndarray, steps: int) -> list[tuple[int, int]]:
    """How many of the sorted ends `a` and `b` lie before each diagonal of their merge, first and last included.

    On diagonal d the first d ends of the merge hold i of `a` and d - i of `b`; i is found by binary search,
    and equal ends count in `a` first.
    """
    found = [(0, 0)]
    for d in range(steps, len(a) + len(b), steps):
        low, high = max(0, d - len(b)), min(d, len(a))
        while low < high:
            i = (low + high) // 2
            if a[i] <= b[d - 1 - i]:
                low = i + 1
            else:
                high = i
        found.append((low, d - low))
    return [*found, (len(a), len(b))]


def _cut(first: Vocabulary, second: Vocabulary, steps: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = first.encoder(), second.encoder()
        rows: list[tuple] = []
        held = 0

        def full() -> pa.RecordBatch:
            docs = batch.column("doc").take(pa.array([r[0] for r in rows], pa.int64()))
            rest = _batch([r[1:] for r in rows], PIECES)
            return pa.RecordBatch.from_arrays([docs, *rest.columns], ["doc", *rest.schema.names])

        for batch in batches:
            texts, numbers = batch.column("text").to_pylist(), batch.column("row").to_pylist()
            for start in range(0, len(texts), 64):
                part = [x or "" for x in texts[start : start + 64]]
                for at, text, a, b in zip(range(start, start + 64), part, one(part), two(part), strict=False):
                    said = b" " + text.encode()
                    if not text or not (first.restores(a, said) and second.restores(b, said)):
                        a, b = [], []
                    # an array of C numbers takes a list in faster than numpy does
                    a, b = np.frombuffer(array(first.code, a), first.kind), np.frombuffer(array(second.code, b), second.kind)
                    if len(a) + len(b) <= steps:
                        rows.append((at, numbers[at], 0, 1, len(a), len(b), 0, 0, a.tobytes(), b.tobytes()))
                        held += a.nbytes + b.nbytes + 64
                    else:
                        ends = np.cumsum(first.lengths[a]), np.cumsum(second.lengths[b])
                        edges = cuts(*ends, steps)
                        for k, ((i, j), (m, n)) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                            # one token more on either side, as the last ones may reach over the edge
                            x, y = a[i : m + 1].tobytes(), b[j : n + 1].tobytes()
                            base = int(ends[0][i - 1]) if i else 0, int(ends[1][j - 1]) if j else 0
                            rows.append((at, numbers[at], k, len(edges) - 1, m - i, n - j, *base, x, y))
                            held += len(x) + len(y) + 64
                            if held >= BATCH:
                                yield full()
                                rows, held = [], 0
                    if held >= BATCH:
                        yield full()
                        rows, held = [], 0
            if rows:
                yield full()
                rows, held = [], 0

    return cut


def pieces(
    docs: DataFrame,
    first: Vocabulary,
    second: Vocabulary,
    text: str = "text",
    keep: list[str] | None = None,
    steps: int = STEPS,
) -> DataFrame:
    """Every text's pieces: slices of its A and B ids with the byte offsets at which they start.

    Texts that are null or empty, or whose joined tokens differ from the text with a space before it, have one
    piece without ids. `doc` is a struct of the columns `keep` (by default all), `row` numbers the rows.
    """
    keep = docs.columns if keep is None else keep
    packed = docs.select(
        F.struct(*keep).alias("doc"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text")
    )
    schema = StructType([packed.schema["doc"], *StructType.fromDDL(PIECES)])
    return packed.mapInArrow(_cut(first, second, steps), schema)


def merged(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, a_base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The links of one piece and its ends of groups, from the ends of its slices.

    Returns the indices of the A token and the B token of each link, those of A's own ends first, and which of B's
    own ends close a group. An end of B that A has too is no link of its own: A comes first and has emitted it.
    """
    own_a, own_b = a[:n_a], b[:n_b]
    under_a = np.searchsorted(b, own_a)
    under_b = np.searchsorted(a, own_b)
    both = own_b == a_base
    inside = under_b < len(a)
    both[inside] |= a[under_b[inside]] == own_b[inside]
    free = ~both
    return (
        np.concatenate([np.arange(n_a), under_b[free]]),
        np.concatenate([under_a, np.flatnonzero(free)]),
        both,
    )


class _Printer:
    """Writes groups as `a1,a2|b1;a3|b2,b3`."""

    def __init__(self, size: int):
        self.size = size
        self.table = np.array([f"{k}{c}" for c in ",|;" for k in range(size)], dtype="S")

    def __call__(self, a: np.ndarray, group_a: np.ndarray, b: np.ndarray, group_b: np.ndarray) -> bytes:
        out = np.empty(len(a) + len(b), np.int64)
        last_a = np.append(group_a[1:] != group_a[:-1], True)[: len(a)]
        last_b = np.append(group_b[1:] != group_b[:-1], True)[: len(b)]
        groups = np.arange(1 + max(group_a[-1:].max(initial=-1), group_b[-1:].max(initial=-1)) + 1)
        out[np.arange(len(a)) + np.searchsorted(group_b, groups)[group_a]] = a + self.size * last_a
        out[np.arange(len(b)) + np.searchsorted(group_a, groups, "right")[group_b]] = b + 2 * self.size * last_b
        return self.table[out].tobytes().translate(None, b"\0")[:-1]


def _listed(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def _slices(batches: Iterator[pa.RecordBatch], first: np.ndarray, second: np.ndarray, kinds: tuple):
    """For each piece its row as a dict, its ids, and its links and closing ends."""
    for batch in batches:
        columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        for k in range(batch.num_rows):
            row = {name: column[k] for name, column in columns.items()}
            a, b = np.frombuffer(row["a"], kinds[0]).astype(np.int64), np.frombuffer(row["b"], kinds[1]).astype(np.int64)
            end_a, end_b = row["a_base"] + np.cumsum(first[a]), row["b_base"] + np.cumsum(second[b])
            yield row, a, b, merged(end_a, end_b, row["n_a"], row["n_b"], row["a_base"])


def _counted(first: np.ndarray, second: np.ndarray, kinds: tuple):
    width = len(second)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        codes, times = np.empty(0, np.int64), np.empty(0, np.int64)

        def settled():
            values, sums = np.unique(np.concatenate(waiting), return_counts=True)
            every, at = np.unique(np.concatenate([codes, values]), return_inverse=True)
            total = np.zeros(len(every), np.int64)
            np.add.at(total, at, np.concatenate([times, sums]))
            return every, total

        def out():
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(times)], ["code", "n"])

        for _, a, b, (i, j, _) in _slices(batches, first, second, kinds):
            waiting.append(a[i] * width + b[j])
            held += len(i)
            if held >= AT_ONCE:
                codes, times = settled()
                waiting, held = [], 0
                if len(codes) >= AT_ONCE:
                    yield out()
                    codes, times = codes[:0], times[:0]
        if waiting:
            codes, times = settled()
        if len(codes):
            yield out()

    return count


def _summed(first: np.ndarray, second: np.ndarray, kinds: tuple, heavy: tuple):
    width, (known, counts, best) = len(second), heavy

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write, rows, held = _Printer(max(len(first), len(second))), [], 0
        for row, a, b, (i, j, closing) in _slices(batches, first, second, kinds):
            # only sums are wanted, and sorted codes are looked up faster
            codes = np.sort(a[i] * width + b[j])
            at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
            found = known[at] == codes if len(known) else np.zeros(len(codes), bool)
            rare, times = np.unique(codes[~found], return_counts=True)
            at = at[found]
            own_a, own_b = a[: row["n_a"]], b[: row["n_b"]]
            # how many ends before a token close a group
            closed = np.concatenate([[0], np.cumsum(closing)])
            group_a, group_b, n = closed[j[: row["n_a"]]], closed[:-1], int(closed[-1])
            sha, fragments = None, (None,) * 5
            if row["pieces"] == 1:
                said = write(own_a, group_a, own_b, group_b) if len(own_a) else b""
                sha = hashlib.sha256(said).hexdigest() if said else ""
            else:
                part = lambda k: (_listed(own_a[group_a == k]), _listed(own_b[group_b == k]))
                inner_a, inner_b = (group_a > 0) & (group_a < n), (group_b > 0) & (group_b < n)
                inner = write(own_a[inner_a], group_a[inner_a], own_b[inner_b], group_b[inner_b]).decode()
                fragments = (*part(0), inner, *(part(n) if n else ("", "")))
            rows.append((
                row["row"], row["pieces"], row["piece"], row["n_a"], row["n_b"], n, len(codes),
                int(best[at].sum()), int(counts[at].sum()), sha, n > 0, *fragments,
                rare.tolist(), times.tolist(),
            ))
            held += 200 + 16 * len(rare) + (6 * (len(a) + len(b)) if sha is None else 0)
            if held >= BATCH:
                yield _batch(rows, MERGED)
                rows, held = [], 0
        if rows:
            yield _batch(rows, MERGED)

    return summed


def _stitched(parts: pd.DataFrame) -> pd.DataFrame:
    """The groups of one text from its pieces: what one piece leaves open the next ones continue."""
    done: list[str] = []
    open_a: list[str] = []
    open_b: list[str] = []
    for p in parts.sort_values("piece").itertuples():
        open_a += [p.head_a] if p.head_a else []
        open_b += [p.head_b] if p.head_b else []
        if p.closes:
            done.append(f"{','.join(open_a)}|{','.join(open_b)}")
            done += [p.middle] if p.middle else []
            open_a, open_b = [p.tail_a] if p.tail_a else [], [p.tail_b] if p.tail_b else []
    text = ";".join(done)
    return pd.DataFrame({"row": [parts["row"].iloc[0]], "sha": [hashlib.sha256(text.encode()).hexdigest()]})


def align(
    docs: DataFrame,
    first: Vocabulary,
    second: Vocabulary,
    text: str = "text",
    keep: list[str] | None = None,
    steps: int = STEPS,
    heavy: int = HEAVY,
) -> DataFrame:
    """How the tokens of two vocabularies lie over each other in every text of `docs`.

    Returns `doc` (a struct of the columns `keep`, by default all), `row`, `n_a`, `n_b`, `n_groups`, `n_links`,
    `n_best`, `count_sum` and `groups_sha256`. Texts that are null or empty, or that the tokens do not restore,
    have zeros and an empty digest. Repeated rows are rows of their own and all count. Empty tables give no rows.
    """
    spool = Spool(docs.sparkSession, "alignment")
    cut = spool.write(pieces(docs, first, second, text, keep, steps))
    lengths, kinds, width = (first.lengths, second.lengths), (first.kind, second.kind), len(second.tokens)
    ids = cut.drop("doc")
    sums = ids.mapInArrow(_counted(*lengths, kinds), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counted = spool.write(sums)
    other = (F.col("code") % width).alias("b")
    most = counted.groupBy(other).agg(F.max("n").alias("most"))  # a row for each id of B
    pairs = spool.write(
        counted.withColumn("b", F.col("code") % width)
        .join(most, "b")
        .select("code", "n", (F.col("n") == F.col("most")).alias("best"))
    )
    total = counted.agg(F.sum("n")).first()[0] or 0
    common = pairs.where(F.col("n") * heavy >= total).toArrow().sort_by("code")  # at most `heavy` rows
    looked_up = tuple(common[name].to_numpy() for name in ("code", "n", "best"))

    parts = spool.write(ids.mapInArrow(_summed(*lengths, kinds, looked_up), MERGED))
    rare = (
        parts.where(F.size("codes") > 0)
        .select("row", F.explode(F.arrays_zip("codes", "times")).alias("pair"))
        .select("row", F.col("pair.codes").alias("code"), F.col("pair.times").alias("times"))
        .join(pairs, "code")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rare_best"),
            F.sum(F.col("times") * F.col("n")).alias("rare_sum"),
        )
    )
    sums = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    several = parts.where("pieces > 1")
    shas = several.select(
        "row", "piece", "closes", "head_a", "head_b", "middle", "tail_a", "tail_b"
    ).groupBy("row").applyInPandas(_stitched, "row long, sha string")
    whole = several.groupBy("row").agg(*(F.sum(c).alias(c) for c in sums)).join(shas, "row")
    every = parts.where("pieces = 1").select("row", *sums, "sha").unionByName(whole)
    plus = lambda name, more: (F.col(name) + F.coalesce(F.col(more), F.lit(0))).alias(name)
    result = spool.write(
        every.join(rare, "row", "left").select(
            "row", "n_a", "n_b", "n_groups", "n_links", plus("n_best", "rare_best"), plus("count_sum", "rare_sum"),
            F.col("sha").alias("groups_sha256"),
        )
    )
    named = spool.write(cut.where("piece = 0").select("doc", "row"))
    spool.drop(cut, counted, pairs, parts)
    return named.join(result, "row").select("doc", *result.columns)
